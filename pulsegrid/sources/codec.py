"""Binary form of a measurement: two header bytes, then an Avro body.

Spark's own Avro functions do the work where their jar is on the class path. Elsewhere both
directions are Arrow UDFs over whole batches: every step reads or writes one token of *all* rows
of a batch with numpy, so no Python runs per row.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.schema import FIELDS, TAGS

# The header of a version 1 record.
MAGIC = 1
VERSION = 1

# Fixed value: the schema of a version 1 body.
AVRO_SCHEMA = json.dumps({"type": "record", "name": "MeasurementV1", "fields": [
    {"name": "timestamp", "type": "long"},
    {"name": "name", "type": "string"},
    {"name": "tags", "type": {"type": "map", "values": "string"}},
    {"name": "fields", "type": {"type": "map", "values": "double"}},
]})

DECODED = T.StructType([
    T.StructField("ms", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("tags", TAGS),
    T.StructField("fields", FIELDS),
    T.StructField("error", T.StringType()),
])


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of pieces laid end to end, and where each of their bytes comes from."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return offsets, np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets, source = _ragged(starts, lengths)
    return pa.StringArray.from_buffers(
        len(lengths), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[source]))


def _binary_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of a binary or string array; a null is empty."""
    if array.offset:
        array = pa.concat_arrays([array])
    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    ends = np.zeros(1, np.int64) if offsets is None else np.frombuffer(
        offsets, np.int64 if wide else np.int32)[: len(array) + 1].astype(np.int64)
    pool = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return pool, ends[:-1], ends[1:]


class _Reader:
    """Reads the next token of many rows at once; a row that runs out of bytes turns bad."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.pos, self.end = data, starts.copy(), ends
        self.bad = np.zeros(len(starts), bool)

    def longs(self, rows: np.ndarray) -> np.ndarray:
        value = np.zeros(len(rows), np.uint64)
        live = np.arange(len(rows))
        for group in range(10):
            short = self.pos[rows[live]] >= self.end[rows[live]]
            self.bad[rows[live[short]]] = True
            live = live[~short]
            byte = self.data[self.pos[rows[live]]]
            self.pos[rows[live]] += 1
            value[live] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * group)
            live = live[byte >= 0x80]
            if not len(live):
                break
        self.bad[rows[live]] = True
        return (value >> np.uint64(1)).view(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)

    def skip(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the next bytes of each row; bad rows get length zero."""
        starts = self.pos[rows]
        self.bad[rows] |= (lengths < 0) | (lengths > self.end[rows] - starts)
        lengths = np.where(self.bad[rows], 0, lengths)
        self.pos[rows] += lengths
        return starts, lengths

    def good(self, rows: np.ndarray) -> np.ndarray:
        return rows[~self.bad[rows]]


def _read_map(reader: _Reader, rows: np.ndarray, read_value) -> tuple[pa.Array, list, np.ndarray]:
    """Keys, raw values and row of every entry of one map per row, repeated keys removed."""
    left = np.zeros(len(reader.pos), np.int64)
    rows = reader.good(rows)
    of_row, keys, lengths, values = [], [], [], []
    while len(rows):
        fresh = rows[left[rows] == 0]
        count = reader.longs(fresh)
        sized = fresh[count < 0]
        reader.longs(sized)
        left[fresh] = np.abs(count)
        rows = reader.good(rows[left[rows] != 0])
        start, length = reader.skip(rows, reader.longs(rows))
        value = read_value(rows)
        of_row.append(rows), keys.append(start), lengths.append(length), values.append(value)
        left[rows] -= 1
    if not of_row:
        return pa.array([], pa.string()), [], np.zeros(0, np.int64)
    of_row = np.concatenate(of_row)
    order = np.argsort(of_row, kind="stable")
    order = order[~reader.bad[of_row[order]]]
    of_row = of_row[order]
    names = _strings(reader.data, np.concatenate(keys)[order], np.concatenate(lengths)[order])
    parts = [np.concatenate(part)[order] for part in zip(*values)]
    if len(of_row):
        # a map that repeats a key keeps the last value
        codes = names.dictionary_encode().indices.to_numpy()
        identity = of_row * len(names) + codes
        _, from_end = np.unique(identity[::-1], return_index=True)
        if len(from_end) < len(of_row):
            kept = np.sort(len(of_row) - 1 - from_end)
            names, of_row, parts = names.take(pa.array(kept)), of_row[kept], [p[kept] for p in parts]
    return names, parts, of_row


def _map_array(size: int, of_row: np.ndarray, keys: pa.Array, values: pa.Array) -> pa.Array:
    offsets = np.zeros(size + 1, np.int32)
    np.cumsum(np.bincount(of_row, minlength=size), out=offsets[1:])
    return pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), keys, values)


def decode_batch(values: pa.Array) -> pa.Array:
    """One struct (ms, name, tags, fields, error) per binary record; a null record stays empty."""
    size = len(values)
    absent = values.is_null().to_numpy(zero_copy_only=False)
    data, starts, ends = _binary_parts(values)
    reader = _Reader(data, starts, ends)
    everyone = np.arange(size)

    headed = everyone[~absent & (ends - starts >= 2)]
    version = np.zeros(size, np.int64)
    version[headed] = data[starts[headed] + 1].view(np.int8)
    reader.pos += 2
    rows = headed[version[headed] == VERSION]
    reader.bad[:] = True
    reader.bad[rows] = False

    ms = np.zeros(size, np.int64)
    ms[rows] = reader.longs(rows)
    rows = reader.good(rows)
    name_start, name_length = np.zeros((2, size), np.int64)
    name_start[rows], name_length[rows] = reader.skip(rows, reader.longs(rows))

    tag_keys, tag_values, tag_rows = _read_map(
        reader, rows, lambda r: reader.skip(r, reader.longs(r)))
    field_keys, field_values, field_rows = _read_map(
        reader, rows, lambda r: reader.skip(r, np.full(len(r), 8)))

    keep = ~reader.bad[tag_rows]
    if not keep.all():
        tag_keys, tag_rows = tag_keys.filter(pa.array(keep)), tag_rows[keep]
        tag_values = [part[keep] for part in tag_values]
    no_strings = pa.array([], pa.string())
    tag_texts = _strings(data, *tag_values) if len(tag_rows) else no_strings
    doubles = np.zeros(0)
    if len(field_rows):
        doubles = data[field_values[0][:, None] + np.arange(8)].copy().view("<f8").ravel()

    problem = np.full(size, None, object)
    problem[reader.bad] = "malformed measurement body"
    other = headed[version[headed] != VERSION]
    problem[other] = [f"unsupported measurement version {v}" for v in version[other]]
    problem[absent] = None

    empty = pa.array(reader.bad)
    names = _strings(data, name_start, np.where(reader.bad, 0, name_length))
    return pa.StructArray.from_arrays(
        [pa.array(ms, mask=reader.bad),
         pa.compute.if_else(empty, pa.scalar(None, pa.string()), names),
         _map_array(size, tag_rows, tag_keys, tag_texts),
         _map_array(size, field_rows, field_keys, pa.array(doubles, pa.float64())),
         pa.array(problem, pa.string())],
        names=[f.name for f in DECODED.fields])


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zigzag varints in rows of ten bytes, and the length of each."""
    zigzag = ((values << 1) ^ (values >> 63)).view(np.uint64)
    shifted = zigzag[:, None] >> (np.arange(10, dtype=np.uint64) * np.uint64(7))
    length = 1 + (shifted[:, 1:] != 0).sum(axis=1)
    more = np.arange(10) < (length - 1)[:, None]
    return ((shifted & np.uint64(0x7F)).astype(np.uint8) | (more * np.uint8(0x80))), length


class _Writer:
    """Places pieces of bytes at numbered slots, then lays the slots end to end."""

    def __init__(self, slots: int):
        self.start, self.length = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        self.pools, self.size = [], 0

    def put(self, slots: np.ndarray, pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.start[slots], self.length[slots] = starts + self.size, lengths
        self.pools.append(pool)
        self.size += len(pool)

    def put_longs(self, slots: np.ndarray, values: np.ndarray, omit_zero: bool = False):
        digits, length = _varints(values)
        length = np.where(values == 0, 0, length) if omit_zero else length
        self.put(slots, digits.ravel(), np.arange(len(values)) * 10, length)

    def put_texts(self, slots: np.ndarray, texts: pa.Array):
        """A length, in the given slots, and the text, in the slots after them."""
        pool, starts, ends = _binary_parts(texts)
        self.put_longs(slots, ends - starts)
        self.put(slots + 1, pool, starts, ends - starts)

    def records(self, first_slots: np.ndarray) -> pa.Array:
        offsets, source = _ragged(self.start, self.length)
        pool = np.concatenate(self.pools)
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(first_slots) - 1,
            [None, pa.py_buffer(offsets[first_slots].astype(np.int32)), pa.py_buffer(pool[source])])


def _map_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Entries per row, row of each entry, its place in the row, and all keys and values; null values are left out."""
    if array.offset:
        array = pa.concat_arrays([array])
    offsets = np.asarray(array.offsets).astype(np.int64)
    counts = np.diff(offsets)
    of_row = np.repeat(np.arange(len(counts)), counts)
    span = (offsets[0], offsets[-1] - offsets[0])
    keys, values = array.keys.slice(*span), array.items.slice(*span)
    if values.null_count:
        kept = values.is_valid()
        of_row, keys, values = of_row[kept.to_numpy(zero_copy_only=False)], keys.filter(kept), values.filter(kept)
        counts = np.bincount(of_row, minlength=len(counts))
    place = np.arange(len(of_row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return counts, of_row, place, keys, values


def encode_batch(ms: pa.Array, name: pa.Array, tags: pa.Array, fields: pa.Array) -> pa.Array:
    """The binary record of each measurement."""
    size = len(ms)
    tag_counts, tag_rows, tag_place, tag_keys, tag_texts = _map_parts(tags)
    field_counts, field_rows, field_place, field_keys, field_values = _map_parts(fields)

    # slots of a row: header, ms, name (2), tag count, 4 a tag, end, field count, 3 a field, end
    first = np.zeros(size + 1, np.int64)
    np.cumsum(8 + 4 * tag_counts + 3 * field_counts, out=first[1:])
    base = first[:-1]
    tag_slot = base[tag_rows] + 5 + 4 * tag_place
    tags_end = base + 5 + 4 * tag_counts
    field_slot = tags_end[field_rows] + 2 + 3 * field_place
    zeros, twos = np.zeros(size, np.int64), np.full(size, 2)

    out = _Writer(int(first[-1]))
    out.put(base, np.array([MAGIC, VERSION], np.uint8), zeros, twos)
    out.put_longs(base + 1, np.asarray(ms).astype(np.int64))
    out.put_texts(base + 2, name)
    out.put_longs(base + 4, tag_counts, omit_zero=True)
    out.put_texts(tag_slot, tag_keys)
    out.put_texts(tag_slot + 2, tag_texts)
    out.put_longs(tags_end, zeros)
    out.put_longs(tags_end + 1, field_counts, omit_zero=True)
    out.put_texts(field_slot, field_keys)
    doubles = np.asarray(field_values).astype("<f8")
    out.put(field_slot + 2, doubles.view(np.uint8), np.arange(len(doubles)) * 8,
            np.full(len(doubles), 8))
    out.put_longs(first[1:] - 1, zeros)
    return out.records(first)


@F.arrow_udf(DECODED)
def _decode(value: pa.Array) -> pa.Array:
    return decode_batch(value)


@F.arrow_udf(T.BinaryType())
def _encode(ms: pa.Array, name: pa.Array, tags: pa.Array, fields: pa.Array) -> pa.Array:
    return encode_batch(ms, name, tags, fields)


# Both are pure. They are declared otherwise so that a filter on their result is not moved
# before them, which would run them a second time.
_decode_once = _decode.asNondeterministic()
_encode_once = _encode.asNondeterministic()


def has_avro(spark: SparkSession) -> bool:
    """Whether Spark's own Avro functions are on the class path."""
    try:
        spark.range(0).select(F.call_function("from_avro", F.lit(b""), F.lit(AVRO_SCHEMA))).schema
        return True
    except PySparkException:
        return False


def _decode_builtin(value: Column) -> Column:
    """The same struct by Spark's own reader; a damaged body comes back as null."""
    version = F.conv(F.hex(F.substring(value, 2, 1)), 16, 10).cast("int")
    lenient = F.create_map(F.lit("mode"), F.lit("PERMISSIVE"))
    body = F.call_function("from_avro", F.when(version == VERSION, F.substring(value, 3, 2 ** 31 - 1)),
                           F.lit(AVRO_SCHEMA), lenient)
    error = (F.when(value.isNull(), F.lit(None).cast("string"))
             .when(version.isNotNull() & (version != VERSION), F.concat(
                 F.lit("unsupported measurement version "), version.cast("string")))
             .when(body["name"].isNull(), "malformed measurement body"))
    return F.struct(body["timestamp"].alias("ms"), body["name"].alias("name"),
                    body["tags"].alias("tags"), body["fields"].alias("fields"), error.alias("error"))


def decode_avro_v1(value: Column | str = "value") -> Column:
    """Binary record to struct (ms, name, tags, fields, error). The magic byte is not looked at.

    Spark's own Avro reader is used where its jar is there, else an Arrow UDF.
    """
    value = F.col(value) if isinstance(value, str) else value
    return _decode_builtin(value) if has_avro(SparkSession.active()) else _decode_once(value)


def encode_avro_v1(df: DataFrame, column: str = "value") -> DataFrame:
    """Add the binary record of each measurement. Null values in a map are left out."""
    if has_avro(df.sparkSession):
        tags, fields = (F.map_filter(m, lambda _k, v: v.isNotNull()) for m in ("tags", "fields"))
        record = F.struct(F.unix_millis("ts").alias("timestamp"), F.col("name"), tags.alias("tags"),
                          fields.alias("fields"))
        body = F.call_function("to_avro", record, F.lit(AVRO_SCHEMA))
        return df.withColumn(column, F.concat(F.lit(bytes([MAGIC, VERSION])), body))
    return df.withColumn(column, _encode_once(F.unix_millis("ts"), F.col("name"), F.col("tags"), F.col("fields")))
