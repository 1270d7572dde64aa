"""Measurements as text, to look at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.schema import tag_entries

# How a time is written.
TIME_FORMAT = "dd/MM/yyyy G 'at' HH:mm:ss z"


def measurement_text() -> Column:
    """``name,k=v [time] `` and a line of tab-ended fields. Tags and fields are sorted."""
    tags = F.transform(tag_entries("tags"), lambda e: F.concat(F.lit(","), e["key"], F.lit("="), e["value"]))
    fields = F.transform(F.sort_array(F.map_entries("fields")),
                         lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"), F.lit("\t")))
    return F.concat(
        F.col("name"), F.array_join(tags, ""),
        F.lit(" ["), F.date_format("ts", TIME_FORMAT), F.lit("] \n"),
        F.array_join(fields, ""), F.lit("\n\n"))


def format_measurements(df: DataFrame) -> DataFrame:
    """One text per row; a record that could not be decoded gives its error message."""
    text = measurement_text()
    if "error" in df.columns:
        text = F.when(F.col("error").isNull(), text).otherwise(F.concat("error", F.lit("\n\n")))
    return df.select(text.alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    """One text after another; the writer adds the last line end of each."""
    texts = format_measurements(df).select(
        F.col("value").substr(F.lit(1), F.length("value") - 1).alias("value"))
    texts.write.mode("overwrite").option("lineSep", "\n").text(path)
