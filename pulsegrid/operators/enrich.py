"""Tags from an inventory of brokers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.tags import empty_tags, overlay_map, service_tag
from pulsegrid.operators.skew import salted_join


def broker_addresses(brokers: DataFrame) -> DataFrame:
    """Brokers (id, host, port, jmx_port) with their scan section, address and service."""
    return brokers.select(
        "*", (F.col("id").cast("int") + 1).alias("section"),
        F.concat_ws(":", "host", F.col("jmx_port").cast("string")).alias("address"),
        service_tag("id").alias("service"))


def enrich_with_inventory(df: DataFrame, brokers: DataFrame, cluster: Column | str,
                          spread: list[str]) -> DataFrame:
    """Add host, service and name (the cluster) to the tags of rows that have a broker's address.

    Tags of the row win. A row whose address is not in the inventory is kept as it is. Of several brokers at one
    address the one with the least id counts.
    ``spread`` names columns that tell the rows of one address apart.
    """
    cluster = F.lit(cluster) if isinstance(cluster, str) else cluster
    inventory = broker_addresses(brokers).select("address", "section", "id", "host", "service", cluster.alias("cluster"))
    inventory = inventory.groupBy("address").agg(F.min(F.struct("section", "id", "host", "service", "cluster")).alias("_b"))
    inventory = inventory.select("address", F.create_map(
        F.lit("host"), F.col("_b.host"), F.lit("service"), F.col("_b.service"),
        F.lit("name"), F.col("_b.cluster")).alias("_inventory"))
    joined = salted_join(df, inventory, ["address"], spread, "left")
    tags = overlay_map(F.coalesce(F.col("_inventory"), empty_tags()), F.col("tags"))
    return joined.withColumn("tags", tags).drop("_inventory").select(*df.columns)
