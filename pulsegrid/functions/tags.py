"""Tags: precedence, names, scopes, object names and series labels."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.schema import TAGS

# How one property of an object name is written, with quoted values kept whole.
OBJECT_PROPERTY = r'([^=,]+)=("(?:[^"\\]|\\.)*"|[^,]*)'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_tags() -> Column:
    return F.create_map().cast(TAGS)


def literal_map(values: dict[str, str]) -> Column:
    if not values:
        return empty_tags()
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def overlay_map(base: Column, over: Column) -> Column:
    """Both maps together; where both have a key, ``over`` wins."""
    return F.map_zip_with(base, over, lambda _key, b, o: F.coalesce(o, b))


def with_fixed_tags(df: DataFrame, tags: dict[str, str], column: str = "tags") -> DataFrame:
    """Add constant tags. A tag that the record has itself wins."""
    return df.withColumn(column, overlay_map(literal_map(tags), F.col(column))) if tags else df


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def last_wins_map(keys: Column, values: Column) -> Column:
    """A map from two lists in which a repeated key keeps its last value."""
    def of(pair: Column) -> Column:
        k, v = pair["k"], pair["v"]
        last = F.transform(
            F.array_distinct(k),
            lambda key: F.element_at(v, (F.size(k) + 1 - F.array_position(F.reverse(k), key)).cast("int")))
        repeated = F.size(F.array_distinct(k)) < F.size(k)
        return F.when(repeated, F.map_from_arrays(F.array_distinct(k), last)).otherwise(
            F.map_from_arrays(k, v))
    return bind(F.named_struct(F.lit("k"), keys, F.lit("v"), values), of)


def present_tags(**tags: Column) -> Column:
    """A map of those tags whose value is neither null nor empty."""
    pairs = [x for key, value in tags.items() for x in (F.lit(key), value)]
    kept = F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull() & (v != ""))
    return kept.cast(TAGS)


def scope_parts(scope: Column | str) -> Column:
    """A squashed scope cut at its dots; trailing empty parts do not count."""
    trimmed = F.regexp_replace(_col(scope), r"\.+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\."))


def is_squashed_scope(group: Column | str, scope: Column | str) -> Column:
    """Whether a scope carries key.value.key.value pairs."""
    squashed = _col(group).startswith("kafka.") & _col(scope).contains(".")
    return F.coalesce(squashed, F.lit(False))


def scope_is_odd(group: Column | str, scope: Column | str) -> Column:
    """Whether a squashed scope has a key without a value, so that it cannot be cut into pairs."""
    return is_squashed_scope(group, scope) & (F.size(scope_parts(scope)) % 2 == 1)


def decompose_scope(scope: Column | str) -> Column:
    """``topic.foo.partition.3`` as the tags topic=foo, partition=3; none for an odd scope."""
    def pairs(parts: Column) -> Column:
        keys = F.filter(parts, lambda _x, i: i % 2 == 0)
        values = F.filter(parts, lambda _x, i: i % 2 == 1)
        return F.when(F.size(parts) % 2 == 0, last_wins_map(keys, values)).otherwise(empty_tags())
    return bind(scope_parts(scope), pairs)


def metric_name_tags(group: Column | str, type_: Column | str, scope: Column | str) -> Column:
    """Tags of a registry metric: group, type, then its scope, whole or cut into pairs."""
    group, type_, scope = _col(group), _col(type_), _col(scope)
    of_scope = F.when(is_squashed_scope(group, scope), decompose_scope(scope)).otherwise(
        present_tags(scope=scope))
    return overlay_map(present_tags(group=group, type=type_), of_scope)


def object_name_parts(object_name: Column | str) -> Column:
    """``domain:k=v,k=v`` as a struct of its domain and its key properties."""
    parts = F.split(_col(object_name), ":", 2)
    properties = F.coalesce(F.get(parts, 1), F.lit(""))
    keys = F.regexp_extract_all(properties, F.lit(OBJECT_PROPERTY), 1)
    values = F.regexp_extract_all(properties, F.lit(OBJECT_PROPERTY), 2)
    return F.struct(F.get(parts, 0).alias("domain"), last_wins_map(keys, values).alias("key_props"))


def _glob(pattern: str) -> str:
    return "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern)


def scope_match(pattern: str, domain: Column | str = "domain",
                key_props: Column | str = "key_props") -> Column:
    """Whether an object name is within a query scope such as ``kafka.*:type=Foo,*``.

    A final ``*`` among the properties allows others; without it the set must be the same.
    """
    domain_glob, _, properties = pattern.partition(":")
    wanted = [p for p in properties.split(",") if p]
    is_open = "*" in wanted
    pairs = [p.split("=", 1) for p in wanted if p != "*"]
    matches = _col(domain).rlike(f"^(?s:{_glob(domain_glob)})$")
    for key, value in pairs:
        found = _col(key_props)[key]
        matches &= F.coalesce(
            found.rlike(f"^(?s:{_glob(value)})$") if set(value) & set("*?") else found == value,
            F.lit(False))
    return matches if is_open else matches & (F.size(_col(key_props)) == len(pairs))


def tag(df: DataFrame, key: str) -> Column:
    """A tag, from its own column ``tag_<key>`` where the table has one, else from the map.

    Parquet can skip on a column but not on a key of a map.
    """
    return F.col(f"tag_{key}") if f"tag_{key}" in df.columns else F.col("tags")[key]


def group_tag(df: DataFrame, key: str) -> Column:
    """A tag for grouping, where a missing tag is the empty string."""
    return F.coalesce(tag(df, key), F.lit(""))


def service_tag(broker_id: Column | str) -> Column:
    return F.concat(F.lit("broker-"), _col(broker_id).cast("string"))


def series_label(alias: str, aggregate: str, tags: dict[str, Column]) -> Column:
    """Legend text: ``$tag_<key>``, ``$col`` (the aggregate's name) or a constant."""
    if alias.startswith("$tag_"):
        return tags[alias.removeprefix("$tag_")]
    return F.lit(aggregate if alias == "$col" else alias)
