"""JSON snapshots of a stream processor: one document holds many groups of metric fields.

Everything here is narrow: a document is taken apart and its fields are grouped by their tags
within the row, so decoding never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.samza import FIELD_TAGS, tag_samza_field
from pulsegrid.functions.tags import bind, last_wins_map, overlay_map
from pulsegrid.functions.values import finite
from pulsegrid.schema import TAGS

# The format version understood, and header keys that are no tags.
SNAPSHOT_VERSION = "0.0.1"
HEADER_NOT_TAGS = ("time", "reset-time", "version")

DOCUMENT = "header map<string,variant>, metrics map<string,map<string,variant>>"
LOOSE_DOCUMENT = "header map<string,variant>, metrics map<string,string>"


def _variant_type(value: Column) -> Column:
    return F.schema_of_variant(value)


def _variant_text(value: Column) -> Column:
    return F.when(_variant_type(value) == "STRING", F.try_variant_get(value, "$", "string"))


def is_number_type(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def is_number(kind: Column, number: Column) -> Column:
    """Whether a JSON value of a variant type, read as a double, is a finite number; text,
    booleans, nulls, objects and integers beyond 64 bits are not.

    A whole number outside the range of a long arrives as a decimal without a fraction.
    """
    beyond_long = kind.startswith("DECIMAL") & kind.endswith(",0)") & (F.abs(number) >= F.lit(2.0 ** 63))
    return is_number_type(kind) & finite(number).isNotNull() & ~beyond_long


def parse_snapshot(df: DataFrame, text: str) -> DataFrame:
    """Add ``_header`` and ``_metrics``. Where a group is no object, the others are still read."""
    strict = F.from_json(F.col(text), DOCUMENT)
    loose = F.from_json(F.col(text), LOOSE_DOCUMENT)["metrics"]
    by_group = F.transform_values(
        loose, lambda _k, v: F.coalesce(F.from_json(v, "map<string,variant>"),
                                        F.create_map().cast("map<string,variant>")))
    df = df.withColumn("_document", strict)
    return (df.withColumn("_header", F.col("_document.header"))
            .withColumn("_metrics", F.coalesce(F.col("_document.metrics"),
                                               F.when(F.col("_header").isNotNull(), by_group)))
            .drop("_document"))


def snapshot_error() -> Column:
    """Why a parsed document is refused, or null."""
    header = F.col("_header")
    shaped = header.isNotNull() & F.col("_metrics").isNotNull() & F.map_contains_key(
        header, "samza-version")
    return (F.when(~F.coalesce(shaped, F.lit(False)), "unrecognized JSON metric format")
            .when(_variant_text(header["version"]).isNull(), "snapshot header without version")
            .when(~F.map_contains_key(header, "time"), "snapshot header without time"))


def json_shape_ok() -> Column:
    """Header, metrics and samza-version are there, and the version is the one understood."""
    return snapshot_error().isNull() & (_variant_text(F.col("_header")["version"]) == SNAPSHOT_VERSION)


def _header_tags() -> Column:
    texts = F.transform(F.map_entries("_header"), lambda e: F.named_struct(
        F.lit("key"), e["key"], F.lit("text"), _variant_text(e["value"])))
    tags = F.filter(texts, lambda e: ~e["key"].isin(*HEADER_NOT_TAGS) & e["text"].isNotNull())
    return bind(tags, lambda t: last_wins_map(t["key"], t["text"])).cast(TAGS)


def _header_time() -> Column:
    time = F.col("_header")["time"]
    kind = _variant_type(time)
    whole = F.when(kind == "BIGINT", F.try_variant_get(time, "$", "bigint"))
    number = F.try_variant_get(time, "$", "double")
    return F.timestamp_millis(F.coalesce(
        whole, F.when(is_number(kind, number), number.cast("bigint")), F.lit(0)))


def _number_fields(group: Column, fields: Column) -> Column:
    """Numeric fields of a group with the tags found in their names, sorted by tags, name
    and place in the document."""
    typed = F.transform(F.map_entries(fields), lambda e, place: F.struct(
        e["key"].alias("key"), place.alias("place"), _variant_type(e["value"]).alias("kind"), e["value"].alias("value")))
    # only these are read as doubles: trying it on text and objects takes most of the time
    read = F.transform(F.filter(typed, lambda x: is_number_type(x["kind"])), lambda x: F.struct(
        x["key"].alias("key"), x["place"].alias("place"), x["kind"].alias("kind"),
        F.try_variant_get(x["value"], "$", "double").alias("value")))
    numbers = F.filter(read, lambda x: is_number(x["kind"], x["value"]))
    return F.sort_array(F.transform(numbers, lambda x: F.struct(
        tag_samza_field(group, x["key"]).alias("named"), x["place"].alias("place"),
        x["value"].alias("value"))))


def _runs_of_equal_tags(df: DataFrame) -> Column:
    """The sorted ``_numbers`` cut into runs that share their tags."""
    numbers, starts, size = F.col("_numbers"), F.col("_starts"), F.size("_numbers")
    return F.transform(starts, lambda s, i: F.slice(
        numbers, s + 1, F.coalesce(F.get(starts, i + 1), size) - s))


def explode_parsed(df: DataFrame) -> DataFrame:
    """Rows of a parsed document: ``_ts``, ``_group``, ``_common`` tags and one ``_run`` of fields.

    A document that is refused, or has no numbers, keeps one row without a run.
    """
    numbers = F.col("_numbers")
    starts = F.filter(
        F.transform(numbers, lambda _x, i: i),
        lambda i: (i == 0) | ~F.get(numbers, i)["named"]["tags"].eqNullSafe(
            F.get(numbers, i - 1)["named"]["tags"]))
    df = df.withColumn("_accepted", F.coalesce(json_shape_ok(), F.lit(False)))
    df = df.select(
        "*", F.when(F.col("_accepted"), _header_time()).alias("_ts"),
        F.when(F.col("_accepted"), _header_tags()).alias("_common"),
        F.explode_outer(F.when(F.col("_accepted"), F.col("_metrics"))).alias("_group", "_members"))
    df = df.drop("_header", "_metrics", "_accepted")
    df = df.withColumn("_numbers", _number_fields(F.col("_group"), F.col("_members")))
    df = df.withColumn("_starts", starts)
    return (df.select("*", F.explode_outer(_runs_of_equal_tags(df)).alias("_run"))
            .drop("_members", "_numbers", "_starts"))


def run_tags() -> Column:
    run = F.col("_run")
    own = F.map_filter(
        F.create_map(*[x for t in FIELD_TAGS for x in (F.lit(t), F.get(run, 0)["named"]["tags"][t])]),
        lambda _k, v: v.isNotNull()).cast(TAGS)
    return overlay_map(F.col("_common"), own)


def run_fields() -> Column:
    """Fields of a run; of a repeated name the last in the document counts."""
    run = F.col("_run")
    last = F.filter(run, lambda x, i: (i == F.size(run) - 1)
                    | (x["named"]["field"] != F.get(run, i + 1)["named"]["field"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["named"]["field"], x["value"])))


def explode_snapshot_json(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per measurement of each accepted document, in place of the text.

    Fields with equal tags share a measurement. Documents that are refused or of another
    version give no row (see ``snapshot_error``).
    """
    rows = explode_parsed(parse_snapshot(df, text)).filter(F.col("_run").isNotNull())
    return rows.select(
        *[c for c in df.columns if c != text], F.col("_ts").alias("ts"),
        F.col("_group").alias("name"), run_tags().alias("tags"), run_fields().alias("fields"))
