"""Names of stream-processor metric fields, which carry tags inside the name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GROUP_PREFIX = "org.apache.samza."
FIELD_TAGS = ("system", "topic", "partition", "broker", "task")

# Patterns in the order they are tried, the tag of each capture, and the
# capture that is left as the field name.
FIELD_PATTERNS = (
    (r"^(.+)-SystemStreamPartition \[([^,]+), ([^,]+), ([0-9]+)\]$",
     {"system": 2, "topic": 3, "partition": 4}, 1),
    (r"^([^-]+)-([^-]+)-([0-9]+)-(.+)$", {"system": 1, "topic": 2, "partition": 3}, 4),
    (r"^([^-]+)-(.+-[0-9]+)-(.+)$", {"system": 1, "broker": 2}, 3),
    (r"^(.+)-partition\s([0-9]+)-(.+)$", {"task": 1, "partition": 2}, 3),
    (r"^partition\s([0-9]+)-(.+)$", {"partition": 1}, 2),
    (r"^([^-]+)-(.+)$", {"system": 1}, 2),
)


def _found(field: Column, pattern: str | None, tags: dict[str, int], rest: int) -> Column:
    def capture(group: int | None) -> Column:
        return (F.lit(None).cast("string") if group is None
                else F.regexp_extract(field, pattern, group))
    left_over = field if pattern is None else capture(rest)
    return F.struct(F.struct(*[capture(tags.get(t)).alias(t) for t in FIELD_TAGS]).alias("tags"),
                    left_over.alias("field"))


def tag_samza_field(group: Column, field: Column) -> Column:
    """The tags found in a field's name (null where not found) and the name left over, as a
    struct (tags, field)."""
    plain = _found(field, None, {}, 0)
    # every pattern needs a dash
    result = F.when(~group.startswith(GROUP_PREFIX) | ~field.contains("-"), plain)
    for pattern, tags, rest in FIELD_PATTERNS:
        result = result.when(field.rlike(pattern), _found(field, pattern, tags, rest))
    return result.otherwise(plain)
