from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from riskspark.llm import suffix_dedup


def brute(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        marks = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                marks[i] += 1
                marks[i + length] -= 1
        gone = np.cumsum(marks)[: len(r)] > 0
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cases():
    rng = random.Random(11)

    def prose(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passage, short = prose(260), prose(199)
    texts = [None, "", "short", passage, f"x{passage}y", f"{prose(90)}{passage}{prose(70)}", short, f"q{short}", f"{short}r"]
    near = prose(1500)
    for _ in range(8):
        cut = list(near)
        for _ in range(4):
            cut[rng.randrange(1500)] = "#"
        texts.append("".join(cut))
    texts += [prose(900)] * 4 + ["z" * 700, "zy" * 300, f"{prose(50)}{'z' * 250}", "tail " * 2000 + prose(300)]
    texts += [f"{prose(rng.randint(1, 400))}{passage[:rng.randint(150, 260)]}{prose(rng.randint(1, 400))}" for _ in range(12)]
    return texts


@pytest.mark.parametrize("full", [4096, 1])
def test_matches_brute_force(spark, monkeypatch, full):
    # With groups of one, every anchor with different runs is compared window by window.
    monkeypatch.setattr(suffix_dedup, "FULL_GROUP", full)
    texts = cases()
    df = spark.createDataFrame([(i % 20 or None, i, t, "c") for i, t in enumerate(texts)], "doc_id int, n int, text string, n_spans string")
    out = suffix_dedup.strip_repeats(df.repartition(5)).collect()
    got = {r["n"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out}
    assert got == dict(enumerate(brute(texts)))


def test_blocks_change_nothing(monkeypatch):
    text = ("".join(random.Random(2).choice("abc ") for _ in range(5000))).encode()
    whole = suffix_dedup.runs_of(text)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    parts = suffix_dedup.runs_of(text)
    for runs in (whole, parts):
        starts = np.concatenate([np.arange(f, f + n) for f, n in zip(runs[2], runs[3])])
        assert starts.tolist() == list(range(len(text) - 199))

    def anchors(runs):
        return {s: (a, f + p) for a, _, f, n, p in zip(*runs) for s in range(f, f + n)}

    assert anchors(whole) == anchors(parts)


def test_intervals_are_those_of_the_prefix_tree():
    found = sorted(suffix_dedup.intervals([2, 5, 5, 1, 3]))
    assert found == [(1, 0, 5), (2, 0, 3), (3, 4, 5), (5, 1, 3)]


def test_kept_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a" * 10), (2, None), (3, "é" * 300), (4, "é" * 300 + "end")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in suffix_dedup.strip_repeats(df, keep_text=True).collect()}
    assert out == {1: "a" * 10, 2: "", 3: "", 4: "end"}
    assert suffix_dedup.strip_repeats(df.limit(0)).collect() == []


def test_names_of_its_own_clash_with_none(spark):
    names = ["k1", "k2", "__spans", "__text", "text", "body", "c0"]
    df = spark.createDataFrame([tuple("abcd") + ("x" * 300, "e", "f")], names)
    out = suffix_dedup.strip_repeats(df, keep_text=True)
    assert out.columns == [n for n in names if n != "text"] + ["n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    assert tuple(out.first())[:6] == tuple("abcdef") and out.first()["n_removed"] == 300


def test_given_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.op3_suffix_intervals(spark, sf_dir).collect()}
    assert got == dict(zip([r[0] for r in rows], brute([r[1] for r in rows])))
