from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from riskspark.llm import runs
from riskspark.llm.common import table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, shortest, exponent):
    """Every maximal stretch of equal words q apart, kept if q is its least period."""
    found = []
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            size = i - start
            if size >= max(shortest, exponent * q):
                if not any(words[start : i - p] == words[start + p : i] for p in range(1, q)):
                    found.append((start, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    dropped = {i for start, n, q in found for i in range(start + q, start + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("part", [50_000, 8])
def test_runs_equal_brute_force(part):
    rng = random.Random(part)
    for _ in range(1500):
        docs = []
        for _ in range(rng.randint(1, 3)):
            n, letters = rng.randint(0, 40), rng.choice([1, 2, 2, 3, 5])
            words = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.7:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 3))
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            docs.append(words)
        shortest, exponent = rng.choice([(6, 4), (1, 2), (4, 3), (6, 2)])
        sizes = np.array([len(d) for d in docs])
        stops = np.cumsum(sizes)
        codes = np.array([w for d in docs for w in d], np.int64)
        got = runs.runs_of(codes, np.repeat(stops - sizes, sizes), np.repeat(stops, sizes), shortest, exponent, part)
        want = {(s + int(o), n, q) for d, o in zip(docs, stops - sizes) for s, n, q in brute_runs(d, shortest, exponent)}
        assert got == want


def test_long_runs_in_small_parts():
    words = [*range(100), *([7, 8, 9] * 5000), *[i % 700 for i in range(9000)], 1, 2]
    codes = np.array(words, np.int64)
    zero, n = np.zeros(len(codes), np.int64), np.full(len(codes), len(codes))
    whole = runs.runs_of(codes, zero, n, 6, 4, 1 << 30)
    assert whole == runs.runs_of(codes, zero, n, 6, 4, 64)
    assert {q for _, _, q in whole} == {3, 700}


def test_edges(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \t\n", "x"),
        (4, "a b c d e", "x"),
        (None, "la la la la la la end", "x"),
        (5, "la " * 30_000, "x"),
        (6, "go  on\nand " * 4 + "stop", "x"),
        (6, "go  on\nand " * 4 + "stop", "x"),
        (7, "w" * 300_000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, collapsed string")
    got = {r["doc_id"]: r for r in runs.periodic_runs(docs).collect()}
    assert [got[i]["n_words"] for i in (1, 2, 3, 4, 7)] == [0, 0, 0, 5, 1]
    assert all(got[i]["runs"] == [] for i in (1, 2, 3, 4, 7)) and got[1]["collapsed"] == ""
    assert [tuple(r) for r in got[None]["runs"]] == [(0, 6, 1)] and got[None]["collapsed"] == "la end"
    assert [tuple(r) for r in got[5]["runs"]] == [(0, 30_000, 1)] and got[5]["collapsed"] == "la"
    assert [tuple(r) for r in got[6]["runs"]] == [(0, 12, 3)] and got[6]["collapsed"] == "go on and stop"
    assert runs.periodic_runs(docs).count() == 9 and runs.periodic_runs(docs.limit(0)).count() == 0
    clash = docs.withColumn("runs", docs.text).withColumn("words", docs.text)
    assert runs.periodic_runs(clash).columns == ["doc_id", "text", "words", "n_words", "runs", "collapsed"]
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, exponent=1)


def test_query_equals_brute_force(spark, sf_dir):
    want = {}
    for doc_id, text in table(spark, sf_dir, "documents", "doc_id", "text").collect():
        words = planted(doc_id, WORDS.findall(text or ""))
        found = brute_runs(words, 6, 4)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want[doc_id] = (
            len(found),
            *best,
            1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest(),
        )
    got = runs.op11_automaton_runs(spark, sf_dir)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    rows = got.collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert sum(r["n_runs"] > 0 for r in rows) > 5
