from __future__ import annotations

from collections import Counter

import zlib

from pyspark.sql import functions as F

from riskspark.llm import sharding


def dealt(spark, rows, shards=5, epsilon=0.0, schema="doc_id long, size long"):
    df = spark.createDataFrame(rows, schema)
    return sharding.assign_shards(df, df.columns[0], shards, epsilon, virtual_nodes=16).collect()


def test_counts_differ_by_one_and_slots_have_no_gaps(spark):
    rows = dealt(spark, [(i, i * 7 % 13) for i in range(103)])
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == 103 and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_nulls_repeats_hot_keys_and_clashing_names(spark):
    rows = [(None, 1, 9, 9)] * 3 + [(1, 1, 9, 9)] * 40 + [(1, i, 9, 9) for i in range(20)]
    out = dealt(spark, rows, schema="doc_id long, size long, shard int, slot long")
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter(r[:2] for r in rows)
    counts = Counter(r["shard"] for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert len({(r["shard"], r["slot"]) for r in out}) == len(rows)


def test_equal_rows_are_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 7)
    out = dealt(spark, [(5, 5)] * 50 + [(6, 6)] * 3)
    assert len({(r["shard"], r["slot"]) for r in out}) == 53


def test_names_of_its_own_clash_with_none(spark):
    names = ["__n", "__arc", "__piece", "c0", "__slice", "shard"]
    df = spark.createDataFrame([(i % 7, *"abcd", 9) for i in range(40)], names)
    out = sharding.assign_shards(df, "__n", 4)
    assert out.columns == [*names[:-1], "shard", "slot"]
    rows = out.collect()
    assert sorted(r["__n"] for r in rows) == sorted(i % 7 for i in range(40))
    assert {tuple(r)[1:5] for r in rows} == {tuple("abcd")}


def test_empty_table(spark):
    assert dealt(spark, []) == []


def test_one_more_shard_moves_little(spark):
    rows = [(i, 1) for i in range(3000)]
    few = {r["doc_id"]: r["shard"] for r in dealt(spark, rows, 8, 0.25)}
    many = {r["doc_id"]: r["shard"] for r in dealt(spark, rows, 9, 0.25)}
    assert max(Counter(few.values()).values()) <= 1.25 * 3000 / 8
    moved = sum(few[i] != many[i] for i in few)
    # A plain modulo would move eight of nine rows.
    assert moved < 3000 / 3


def test_overflow_goes_on_clockwise():
    pieces = sharding.flow([10, 1, 1], [0, 1, 2], [4, 4, 4])
    assert pieces == [[(0, 4), (1, 3), (2, 3)], [(1, 1)], [(2, 1)]]


def test_query(spark, sf_dir):
    out = sharding.op1_ring_shards(spark, sf_dir)
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = out.collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
    counts = out.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(counts) == 40 and max(c["n"] for c in counts) - min(c["n"] for c in counts) <= 1
