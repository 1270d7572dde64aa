"""Grouped prefix join: documents whose sets of word shingles are alike.

Two sets link when ``100 * intersection >= percent * union``. Shingles are ordered: those of one document
first, then by the number of candidate documents that hold them, then by code. Two linked sets then share
a shingle within their first ``n - ceil(percent * n / 100) + 1``. A document whose own shingles fill that
prefix can link with nothing and drops out at once. The rest, mostly near copies, go on:

1. documents with equal sets are one node (the least doc_id);
2. nodes with equal prefixes and sizes are one group; groups that share a prefix shingle are paired if
   sizes, places and 256-bit bitmaps of their sets allow a link;
3. pairs of groups are expanded into pairs of members, whose sets are then compared.

A posting list first joins all its nodes with a few hubs (one and ``HUBS`` more), which needs no pairs of the list. Only groups in different components are paired afterwards, so a large group of near copies costs
some rows for each copy, not one for each pair. No list is cut.

Defined cases: null text, or a text without words, has no shingles, its own doc_id as component, and links
nothing. A null doc_id links nothing and has a null component. Rows that repeat a doc_id are one node; should
their texts differ, it holds the shingles of all. Ids are whole numbers; a table with others is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import forget, query, spread_join, stable, table, text_bytes
from pulsegrid.llm.components import components
from pulsegrid.llm.postings import known_ids, range_count, refuse_other_ids, repeated
from pulsegrid.llm.words import FOLD, SPACED, window_codes, word_hashes


HUBS = 2
DENSE = 32  # groups of a list from which on its entries carry what tells a pair's first list


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle codes of each row of a column of texts."""
    hashes, first = word_hashes(column, SPACED, FOLD)
    codes = window_codes(hashes, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(codes[a:b - size + 1])
        else:  # fewer words: the whole sequence is one shingle
            yield window_codes(hashes[a:b], b - a) if b > a else codes[:0]


def signatures(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc_id, n, sig): size and digest of each row's shingle set; no digest for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary())])

    def sign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = list(shingle_sets(part.column(1), size))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                             pa.binary())], schema=schema)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        sign, "doc_id bigint, n bigint, sig binary")


def shingle_features(size: int):
    """Distinct shingles of a batch, by the first 48 bits of their codes: they only meet within pairs of documents."""
    def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:  # places count for nothing here
        ids = batch.column(0).to_numpy()
        sets = [np.unique(s & ~np.uint64(0xFFFF)) for s in shingle_sets(batch.column(1), size)]
        return np.repeat(ids, [len(s) for s in sets]), np.concatenate(sets) if sets else np.empty(0, np.uint64)
    return features


def with_bitmaps(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, n, codes) to sorted codes, the places left in the prefix, and four words of bitmap.

    Each of 256 bits, chosen by a byte of the code, is the parity of the codes there: so two bitmaps differ in at
    most as many bits as the sets differ in codes.
    """
    names = ["node", "n", "left", "codes", "b0", "b1", "b2", "b3"]
    schema = pa.schema([(x, pa.list_(pa.int64()) if x == "codes" else pa.int64()) for x in names])

    def build(batches):
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            rows = {name: [] for name in names}
            for node, n, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                      strict=True):
                codes = np.unique(codes.values.to_numpy())
                n = max(n, len(codes))
                left = n + (-percent * n // 100) + 1 - (n - len(codes))
                if left <= 0:
                    continue
                parity = np.bincount((codes >> 16).astype(np.uint8), minlength=256) & 1
                bits = np.packbits(parity.astype(np.uint8)).view(">i8").tolist()
                for name, value in zip(names, (node, n, left, codes, *bits), strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return nodes.mapInArrow(build, "node bigint, n bigint, left bigint, codes array<bigint>, "
                                   "b0 bigint, b1 bigint, b2 bigint, b3 bigint")


def prefixes(nodes: DataFrame) -> DataFrame:
    """(node, code): the shared shingles within each node's prefix, rarest among the nodes first."""
    held = nodes.select("node", F.explode("codes").alias("code"))
    # what one node alone holds cannot be shared: it takes up places, and goes no further
    counts = held.groupBy("code").agg(F.count("*").alias("df")).where("df > 1")
    shared = held.join(counts, "code")
    kept = shared.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "code"))).alias("order")).join(
        nodes.select("node", "left", F.size("codes").alias("m")), "node")
    taken = F.col("left") - (F.col("m") - F.size("order"))
    return (kept.where(taken > 0)
            .select("node", F.explode(F.expr("slice(order, 1, int(left - (m - size(order))))")).alias("o"))
            .select("node", F.col("o.code").alias("code")))


def bits_allow(x: str, y: str, percent: int):
    """The bitmaps of two sets do not rule out a link: sizes of the shared sets less the bits that differ."""
    apart = sum((F.bit_count(F.col(f"{x}.b{i}").bitwiseXOR(F.col(f"{y}.b{i}"))) for i in range(4)), F.lit(0))
    most = F.col(f"{x}.m") + F.col(f"{y}.m") - apart  # twice the intersection at most
    return most * (100 + percent) >= 2 * percent * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def sizes_allow(x: str, y: str, percent: int):
    return ((F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent)
            & (F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent))


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link."""
    sets = nodes.select("node", "n", "codes")
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("codes").alias("ca")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("codes").alias("cb")), "b"))
    common = F.size(F.array_intersect("ca", "cb"))
    return both.where(common * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b")


def links(nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between candidate nodes, enough to have all their components."""
    entries = stable(prefixes(nodes))
    prefix = entries.groupBy("node").agg(F.sort_array(F.collect_list("code")).alias("prefix"))
    member = prefix.join(nodes.select("node", "n", F.size("codes").alias("m"), "b0", "b1", "b2", "b3"), "node")
    member = stable(member.withColumn("sign", F.xxhash64("n", "prefix")))

    # one row for each entry and hub of its list
    held = stable(entries.join(member.drop("prefix", "sign"), "node"))
    near = stable(verified(hub_pairs(held, percent), nodes, percent))
    forget(held)
    forget(entries)
    root = components(near, rounds=2)

    # what is left: members of different components, in groups that share a code or are the same
    placed = member.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    group = placed.groupBy("sign", "n", "prefix").agg(
        F.max_by(F.struct("node", "m", "b0", "b1", "b2", "b3"), F.struct("m", "node")).alias("rep"),
        F.count("*").alias("members"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    group = stable(group.select("sign", "n", "prefix", F.col("rep.node").alias("gid"), "rep.m", "rep.b0", "rep.b1",
                                "rep.b2", "rep.b3", "members", "lo", "hi"))
    placed = placed.join(group.select("sign", "n", "prefix", "gid"), ["sign", "n", "prefix"]).drop("sign", "prefix")
    # an entry of a list is what the filters need of its group; the prefix stays behind
    posting = group.drop("sign").withColumn("code", F.explode("prefix")).drop("prefix")
    mixed = posting.groupBy("code").agg(F.min("lo").alias("l"), F.max("hi").alias("h"), F.count("*").alias("groups"))
    posting = stable(posting.join(mixed.where("l != h").select("code", "groups"), "code"))
    # a pair of groups that meets at several codes counts once: in dense lists at the least dense code of both, so that
    # many alike groups make no more rows than pairs; in short ones, where it makes few, copies are dropped afterwards
    dense = posting.where(F.col("groups") > DENSE)
    own = dense.groupBy("gid").agg(F.collect_list("code").alias("dense"))
    once = F.col("x.code") == F.array_min(F.array_intersect("x.dense", "y.dense"))
    groups = stable(group_pairs(posting.where(F.col("groups") <= DENSE), F.lit(True), percent)
                    .unionByName(group_pairs(dense.join(own, "gid"), once, percent)).distinct()
                    .unionByName(group.where("lo != hi").select(F.col("gid").alias("g"), F.col("gid").alias("h"))))
    forget(posting)
    x, y = placed.alias("x"), placed.alias("y")
    pairs = (groups.join(x, F.col("g") == F.col("x.gid"))
             .join(y, (F.col("h") == F.col("y.gid")) & (F.col("x.root") != F.col("y.root"))
                   & ((F.col("g") != F.col("h")) | (F.col("x.node") < F.col("y.node")))
                   & sizes_allow("x", "y", percent) & bits_allow("x", "y", percent))
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    return near.unionByName(verified(pairs, nodes, percent))


def group_pairs(posting: DataFrame, once, percent: int) -> DataFrame:
    """Pairs (g, h) of groups of different components in one list, as far as sizes and bitmaps allow a link."""
    x, y = posting.alias("x"), posting.alias("y")
    alone = (F.col("x.members") == 1) & (F.col("y.members") == 1)
    return (x.join(y, (F.col("x.code") == F.col("y.code")) & (F.col("x.gid") < F.col("y.gid")) & apart("x", "y")
                   & sizes_allow("x", "y", percent) & (~alone | bits_allow("x", "y", percent)) & once)
            .select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h")))


def apart(x: str, y: str):
    """Two groups are not one component already; ``lo`` and ``hi`` are the least and greatest of their members."""
    return ~((F.col(f"{x}.lo") == F.col(f"{x}.hi")) & (F.col(f"{y}.lo") == F.col(f"{y}.hi"))
             & (F.col(f"{x}.lo") == F.col(f"{y}.lo")))


def hub_pairs(held: DataFrame, percent: int) -> DataFrame:
    """Each entry of a list with the list's hubs.

    One hub is the node with the greatest share of shared shingles, such as what others were copied from. The others
    are any, different ones in each list, so that a node of a large group meets several of it.
    """
    columns = [c for c in held.columns if c != "code"]
    ranks = [F.struct(F.col("m") / F.col("n"), "node")] + [
        F.struct(F.xxhash64("node", "code", F.lit(k)), "node") for k in range(HUBS)]
    hubs = held.groupBy("code").agg(*(F.max_by(F.struct(*columns), r).alias(f"h{k}") for k, r in enumerate(ranks)))
    hubs = hubs.select("code", F.explode(F.array_distinct(F.array(*(f"h{k}" for k in range(len(ranks)))))).alias("y"))
    # a list that most nodes are in is dealt to several tasks, each with its hubs
    both = spread_join(held.select("code", F.struct(*columns).alias("x")), hubs, "code", ["x.node"])
    return (both.where((F.col("x.node") != F.col("y.node")) & sizes_allow("x", "y", percent)
                       & bits_allow("x", "y", percent))
            .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct())


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``."""
    refuse_other_ids(docs, doc_id)
    signed = stable(signatures(docs, doc_id, text, size))
    classes = stable(signed.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(
        F.min("doc_id").alias("node"), F.max("n").alias("n")))
    found = repeated(known_ids(docs, doc_id, text), shingle_features(size), range_count(text_bytes(docs, text)), False)
    held = found.groupBy("doc_id").agg(F.collect_list("code").alias("codes"))
    rows = classes.groupBy("node").agg(F.max("n").alias("n")).join(held, F.col("node") == F.col("doc_id"))
    nodes = stable(with_bitmaps(rows.select("node", "n", "codes"), percent))
    root = components(links(nodes, percent))
    placed = classes.join(root, "node", "left").select("sig", F.coalesce("root", "node").alias("component_id"))
    return signed.join(placed, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(
            F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


@query("op4_ngram_jaccard_join")
def op4(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)
