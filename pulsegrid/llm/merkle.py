"""Merkle manifest of a dataset, and proofs of its rows, by exchange of subtrees.

A leaf is the digest of a row's fields. The leaves of a tree (a language) stand in order; while several nodes remain,
every 8 consecutive ones (the last run may be shorter) become the digest of their digests. What remains is the tree's
subroot; the subroots in order of their trees make up one more tree, whose top is the root.

1. Leaves are dealt by range of (tree, order), which numbers them: a task counts its own rows, and one row for each
   task and tree tells what lies before.
2. A superblock is ``8 ** LEVELS`` consecutive nodes. It reduces to one node, so a stage is 4096 times as small as the
   one before it; stages go on until each tree is one node, and then over the subroots.
3. On the way down, the nodes of a superblock are cogrouped with the siblings that its top needs outside of it. The
   cogroup finishes the reduction inside, joins inner and outer siblings to the proof of each node, and folds it.

No group is larger than a superblock, whatever a tree holds. Digests travel, texts do not: a text is read once.

Defined cases: null fields count as ``-``; null trees and null ids come first. Equal ids are ordered by their leaves;
rows that repeat entirely stand next to each other, each a leaf of its own. A lone leaf is its own subroot, a lone
subroot the root, and the proof of a lone leaf in a lone tree is the digest of nothing. An empty table gives no rows.
A null id is never tampered with. Columns other than the named fields are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, stable, table

RUN = 8
LEVELS = 4  # of a superblock
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(field: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(encoded(f) for f in fields)), 256)


def digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def runs_up(nodes: list[str], alone: bool) -> list[list[str]]:
    """The nodes of a superblock, level by level: up to one node if it is all of its tree, else up to ``LEVELS``."""
    levels = [nodes]
    while len(levels[-1]) > 1 if alone else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest(below[k:k + RUN]) for k in range(0, len(below), RUN)])
    return levels


def beside(levels: list[list[str]], place: int) -> Iterator[tuple[str, str]]:
    """The siblings left and right of a node and of each node above it, up to the top of its superblock."""
    for nodes in levels[:-1]:
        first = place - place % RUN
        yield "".join(nodes[first:place]), "".join(nodes[place + 1:first + RUN])
        place //= RUN


@dataclass
class Forest:
    """Stages of trees: nodes (tree, place, size, node); ``size`` is the number of nodes of the tree at this stage.

    The first stage has other columns too. In the last one each tree is one node.
    """

    stages: list[DataFrame]

    @property
    def tops(self) -> DataFrame:
        return self.stages[-1]


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with place (from 0) in its tree and size of the tree; ``order`` ranks rows, trees first."""
    # rows of the same rank are dealt too, by a number of their own
    ranked = stable(rows.withColumn("_copy", F.monotonically_increasing_id()))
    sorted_ = stable(ranked.repartitionByRange(*order, "_copy").sortWithinPartitions(*order, "_copy").drop("_copy"))
    names = sorted_.columns
    at = names.index("tree")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            here = []
            for t in batch.column(at).to_pylist():
                if t != tree:
                    tree, n = t, 0
                here.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(here), pa.int32()), pa.array(here, pa.int64())],
                names=[*names, "part", "own"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_.schema)
    counted = sorted_.mapInArrow(count, f"{kinds}, part int, own bigint")
    parts = counted.groupBy("part", "tree").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("tree")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", "tree", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size"))
    return counted.join(parts, ["part", "tree"]).select(
        *names, (F.col("own") + F.col("before")).alias("place"), "size")


def block(place: str = "place") -> Column:
    return F.floor(F.col(place) / F.lit(RUN ** LEVELS)).cast("bigint")


def grown(leaves: DataFrame) -> Forest:
    """The stages over numbered leaves (tree, place, size, node, ...)."""
    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        nodes = rows.sort_values("place")["node"].tolist()
        size, first = int(rows["size"].iloc[0]), int(rows["place"].min())
        top = runs_up(nodes, size <= RUN ** LEVELS)[-1][0]
        return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "place": [first // RUN ** LEVELS],
                             "size": [-(-size // RUN ** LEVELS)], "node": [top]})

    stages = [leaves]
    while True:
        nodes = stages[-1].select("tree", "place", "size", "node")
        stages.append(stable(nodes.groupBy("tree", block().alias("block")).applyInPandas(
            reduce, "tree string, place bigint, size bigint, node string")))
        if stages[-1].where("size > 1").isEmpty():
            return Forest(stages)


OUTER = "tree string, block bigint, subroot string, root string, lefts array<string>, rights array<string>"


def lowered(forest: Forest, outer: DataFrame) -> DataFrame:
    """From the siblings that each tree needs outside of it to those of each superblock of its leaves.

    ``outer`` has a row for each tree: tree, block 0, what is known above, lefts and rights from the bottom up.
    """
    def join(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes, top = nodes.sort_values("place"), above.iloc[0]
        levels = runs_up(nodes["node"].tolist(), int(nodes["size"].iloc[0]) <= RUN ** LEVELS)
        found = [list(beside(levels, k)) for k in range(len(nodes))]
        return pd.DataFrame({
            "tree": nodes["tree"].tolist(), "block": nodes["place"].tolist(), "subroot": [top["subroot"]] * len(nodes),
            "root": [top["root"]] * len(nodes), "lefts": [[a for a, _ in f] + list(top["lefts"]) for f in found],
            "rights": [[b for _, b in f] + list(top["rights"]) for f in found]})

    # the top stage is one node for each tree, whose siblings are known; above each other stage is a superblock
    for nodes in forest.stages[-2:0:-1]:
        nodes = nodes.withColumn("block", block())
        outer = nodes.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(join, OUTER)
    return outer


def manifest(rows: DataFrame) -> tuple[Forest, Forest]:
    """The stages over the leaves of each tree, and those over the subroots.

    ``rows`` have tree (a name, null allowed), rid (what orders a tree), node (the digest of the row) and any others.
    """
    own = rows.withColumn("name", F.col("tree")).withColumn("tree", encoded(F.col("tree")))
    trees = grown(stable(numbered(own, ["name", "rid", "node"])))
    # the name of a tree is what its key holds behind the colon
    name = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)"))
    tops = trees.tops.select(F.lit("").alias("tree"), name.alias("name"), F.col("tree").alias("key"), "node")
    return trees, grown(stable(numbered(tops, ["tree", "name"])))


def proven(trees: Forest, top: Forest) -> DataFrame:
    """(rid, leaf, subroot, root, proof, folded): each leaf with the digest of its proof and the root that its ``claim`` folds to.

    The leaves have ``claim``: what stands in the row's place when it is checked.
    """
    empty = F.array().cast("array<string>")
    root = top.tops.select("tree", F.lit(0).cast("bigint").alias("block"), F.lit(None).cast("string").alias("subroot"),
                           F.col("node").alias("root"), empty.alias("lefts"), empty.alias("rights"))

    def hang(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        """Every subroot of a superblock with its siblings: what its tree needs."""
        nodes, over = nodes.sort_values("place"), above.iloc[0]
        levels = runs_up(nodes["node"].tolist(), int(nodes["size"].iloc[0]) <= RUN ** LEVELS)
        found = [list(beside(levels, k)) for k in range(len(nodes))]
        return pd.DataFrame({
            "tree": nodes["key"].tolist(), "block": [0] * len(nodes), "subroot": nodes["node"].tolist(),
            "root": [over["root"]] * len(nodes), "lefts": [[a for a, _ in f] + list(over["lefts"]) for f in found],
            "rights": [[b for _, b in f] + list(over["rights"]) for f in found]})

    def finish(leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        leaves, over = leaves.sort_values("place"), above.iloc[0]
        nodes, claims = leaves["node"].tolist(), leaves["claim"].tolist()
        levels = runs_up(nodes, int(leaves["size"].iloc[0]) <= RUN ** LEVELS)
        outer = list(zip(over["lefts"], over["rights"], strict=True))
        proofs, folded = [], []
        for place, claim in enumerate(claims):
            siblings = [*beside(levels, place), *outer]
            proofs.append(digest([a + b for a, b in siblings]))
            at = claim
            for a, b in siblings:
                at = digest([a, at, b])
            folded.append(at)
        return pd.DataFrame({"rid": leaves["rid"].tolist(), "leaf": nodes, "subroot": over["subroot"], "root": over["root"],
                             "proof": proofs, "folded": folded})

    def met(forest: Forest, outer: DataFrame, function, schema: str) -> DataFrame:
        first = forest.stages[0].withColumn("block", block())
        if "rid" in first.columns:
            # whole numbers with nulls would turn into floating point on their way
            first = first.withColumn("rid", F.col("rid").cast("string"))
        return first.groupBy("tree", "block").cogroup(lowered(forest, outer).groupBy("tree", "block")).applyInPandas(
            function, schema)

    kind = trees.stages[0].schema["rid"].dataType
    found = met(trees, met(top, root, hang, OUTER), finish,
                "rid string, leaf string, subroot string, root string, proof string, folded string")
    return found.withColumn("rid", F.col("rid").cast(kind))


def documents_manifest(docs: DataFrame) -> tuple[Forest, Forest]:
    """Leaves of ``documents`` by language; every row whose id's checksum 3 divides claims a text without capitals."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", UPPER, LOWER)
    chosen = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    node = leaf_digest(fields)
    return manifest(docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("rid"), node.alias("node"),
                                F.when(chosen, leaf_digest([*fields[:-1], lower])).otherwise(node).alias("claim")))


def manifest_sql(high: int = 6, wide: int = 2) -> str:
    """The query in SQL, for at most 8**high rows of a language and 8**wide languages."""
    def entry(field: str) -> str:
        return f"CASE WHEN {field} IS NULL THEN '-' ELSE strlen({field}::VARCHAR)::VARCHAR || ':' || {field}::VARCHAR END"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(entry(f) for f in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def levels(name: str, count: int) -> list[str]:
        """From ``name``0 (tree, i, h) upwards; ``name``k_ also has the siblings of every node."""
        out = []
        for k in range(count):
            run = "OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
            out.append(f"""{name}{k}_ AS (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS c,
                coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            out.append(f"""{name}{k + 1} AS (SELECT tree, i // 8 AS i, CASE WHEN max(c) > 1
                THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h FROM {name}{k}_ GROUP BY tree, i // 8)""")
        return out

    def folds(start: str, name: str, count: int) -> list[str]:
        """Proof and fold of each leaf: through the levels of ``name``, from ``start``."""
        out, at = [], start
        for k in range(count):
            tree = "f.tree" if name == "a" else "''"
            place = "f.i" if name == "a" else "f.top"
            out.append(f"""{name}f{k} AS (SELECT f.* EXCLUDE (held, sib), f.sib || w.l || w.r AS sib,
                CASE WHEN w.c > 1 THEN sha256(w.l || f.held || w.r) ELSE f.held END AS held
                FROM {at} f JOIN {name}{k}_ w ON w.tree = {tree} AND w.i = {place} // {8 ** k})""")
            at = f"{name}f{k}"
        return out

    shift = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda x, n: {shift})"
    checksum = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {byte}))"
    steps = [
        f"""rows_ AS (SELECT doc_id, {entry("lang")} AS tree, lang, {leaf("text")} AS leaf,
            CASE WHEN {checksum} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other
            FROM documents)""",
        """leaves AS (SELECT *, coalesce(other, leaf) AS held, '' AS sib,
            row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows_)""",
        "a0 AS (SELECT tree, i, leaf AS h FROM leaves)", *levels("a", high),
        f"""trees AS (SELECT a.tree, a.h, row_number() OVER (ORDER BY n.lang NULLS FIRST) - 1 AS top
            FROM a{high} a JOIN (SELECT DISTINCT tree, lang FROM rows_) n USING (tree))""",
        "b0 AS (SELECT '' AS tree, top AS i, h FROM trees)", *levels("b", wide),
        "hung AS (SELECT l.*, t.top, t.h AS subroot FROM leaves l JOIN trees t USING (tree))",
        *folds("hung", "a", high), *folds(f"af{high - 1}", "b", wide)]
    return f"""WITH {", ".join(steps)}
        SELECT f.doc_id, f.leaf, f.subroot, r.h AS root, sha256(f.sib) AS proof_sha256, f.held AS folded_root,
            f.held = r.h AS verified FROM bf{wide - 1} f, b{wide} r"""


@query("op12_merkle_manifest", manifest_sql())
def op12(spark, sf_dir):
    found = proven(*documents_manifest(table(spark, sf_dir, "documents")))
    return found.select(F.col("rid").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
