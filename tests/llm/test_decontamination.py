from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from riskspark.llm import decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(lowered)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for item_id, item in items:
            its = words(item)
            n = min(10, len(its))
            windows = {tuple(its[i : i + n]) for i in range(len(its) - n + 1)} if its else set()
            for at in range(len(ws) - n + 1):
                if n and tuple(ws[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found.add(item_id)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


PASSAGE = "alpha beta Gamma, delta! epsilon zeta eta theta iota kappa lambda mu nu"
ITEMS = [(1, PASSAGE), (12, "Short item"), (2, None), (3, "..."), (4, "été çà 9"), (12, "Short item"), (None, "secret words"), (20, PASSAGE)]
DOCS = [
    (1, f"Before. {PASSAGE.upper()} after"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (3, "a short item, another short  item"),
    (4, None),
    (5, ""),
    (6, "nothing here"),
    (7, "été çà 9 ÉTÉ"),
    (8, "secret words"),
    (9, "filler " * 20_000 + PASSAGE),
    (6, "nothing here"),
    (None, PASSAGE),
    (10, PASSAGE + " " + PASSAGE),
]


def run(spark, docs, items):
    rows = [(i, t, "x", "y", "z") for i, t in docs]
    # Names that the operator uses itself, too.
    d = spark.createDataFrame(rows, "doc_id long, text string, n_hit string, text_key string, __key string")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.flagged(d, b)
    assert out.columns[:4] == ["doc_id", "text", "text_key", "__key"]
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[n] for n in names) for r in out.collect()), key=str)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_matches_brute_force(spark, monkeypatch, limit):
    # Beyond the limit nothing is broadcast by hint.
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    assert run(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_words_are_those_of_the_pattern(spark):
    texts = ["", " ", "".join(map(chr, range(0x300))), "aZ\x00b\x7f9\xa0É\u2009x🙂", "'a''b' -c-", None, "\n\t x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decontamination.words_of(F.col("t"))).collect()
    assert [list(r[1]) for r in rows] == [words(r[0]) for r in rows]


def test_words_are_cut_once(spark, sf_dir):
    """The plan of the result reads written words; no step cuts texts again."""
    plan = decontamination.op6_prefix_containment(spark, sf_dir)._jdf.queryExecution().toString()
    assert "translate(" not in plan and "split(" not in plan


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, DOCS, []) == brute(DOCS, [])


def test_given_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = decontamination.op6_prefix_containment(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
