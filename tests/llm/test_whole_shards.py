"""The sharding query deals whole documents, and its blocks are bounded in bytes too."""

from collections import Counter

import numpy as np
from pyspark import cloudpickle

from pulsegrid.llm import shuffle_shards


def test_query_deals_whole_documents(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(k, None if k == 7 else f"text {k} é" * k, "en", f"s{k % 3}", k) for k in range(90)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    own = shuffle_shards.shuffled_shards

    def seen(df, *rest):
        kept.append(own(df, *rest))
        return kept[-1]

    monkeypatch.setattr(shuffle_shards, "shuffled_shards", seen)
    got = shuffle_shards.op3(spark, str(tmp_path)).collect()
    assert set(docs.columns) < set(kept[0].columns)
    shards = {(r.shard, r.slot): tuple(r[c] for c in docs.columns) for r in kept[0].collect()}
    assert Counter(shards.values()) == Counter(tuple(r) for r in docs.collect())
    for r in got:
        doc_id, text, *_ = shards[r.shard, r.slot]
        assert (r.doc_id, r["size"]) == (doc_id, len((text or "").encode()) + 16)


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "x" * 1000) for k in range(2000)], "doc_id long, text string").repartition(4)
    asked = []
    own = shuffle_shards.dealer

    def seen(*args):
        asked.append(args)
        return own(*args)

    monkeypatch.setattr(shuffle_shards, "dealer", seen)
    for most in (shuffle_shards.BROADCAST_BLOCKS, 0):  # also where the blocks' places meet the rows in a join
        monkeypatch.setattr(shuffle_shards, "BROADCAST_BLOCKS", most)
        got = shuffle_shards.shuffled_shards(docs, 2, block_bytes=100_000).collect()
        assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(2) for k in range(1000)]
        assert len({r.doc_id for r in got}) == 2000
    sizes, columns, parts, seed = asked[0]
    assert parts >= 10
    blocks = np.concatenate([shuffle_shards.draw(sizes, columns, parts, p, seed)[0] for p in range(len(sizes))])
    assert np.bincount(blocks).max() < 200 and np.bincount(blocks // parts).tolist() == [1000, 1000]


def test_a_task_knows_nothing_of_the_blocks():
    sizes, columns = np.full(50, 1000, np.int64), shuffle_shards.shard_sizes(50_000, 40)
    sent = {len(cloudpickle.dumps(shuffle_shards.dealer(sizes, columns, parts, 0))) for parts in (1_000, 60_000)}
    assert max(sent) - min(sent) < 16
    few, many = (shuffle_shards.draw(sizes, columns, parts, 7, 0) for parts in (1_000, 2 ** 31 - 1))
    assert len(few[0]) == len(many[0]) == 1000 and (few[1] == many[1]).all()
    assert (few[0] // 1_000 == many[0] // (2 ** 31 - 1)).all()
    # blocks follow the order of keys within a shard
    for block, key in (few, many):
        order = np.lexsort((key, block // (1_000 if block is few[0] else 2 ** 31 - 1)))
        assert (np.diff(block[order]) >= 0).all()


def test_order_is_uniform():
    """Each of three rows of two partitions takes each slot of two shards equally often."""
    sizes, columns = np.array([2, 1]), shuffle_shards.shard_sizes(3, 2)
    seen = Counter()
    for seed in range(6000):
        drawn = [shuffle_shards.draw(sizes, columns, 4, p, seed) for p in range(2)]
        block, key = (np.concatenate([d[k] for d in drawn]) for k in (0, 1))
        seen[tuple(np.lexsort((key, block // 4)).tolist())] += 1
    assert len(seen) == 6 and all(abs(n - 1000) < 150 for n in seen.values())
