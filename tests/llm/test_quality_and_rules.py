from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd

from riskspark.llm import quality_classifier, rules

EDGES = [(1, None), (2, ""), (3, "a"), (None, "some text"), (4, "long text " * 30_000), (4, "long text " * 30_000)]


def auc(scores, labels):
    scores, labels = np.asarray(scores), np.asarray(labels)
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2


def test_compression_separates_held_out_documents(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    got = quality_classifier.op7_compression_quality(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got["doc_id"], got["held_out"]))
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert auc(held["score"], held["quality"]) > 0.9


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in EDGES], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_classifier.classify(docs, none).collect()
    assert len(out) == len(EDGES) and {r["score"] for r in out} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 1), (9, None), (None, 1)], "doc_id long, quality int")
    out = quality_classifier.classify(docs, labels).collect()
    by_text = {}
    for r in out:
        by_text.setdefault(r["text"] or "", set()).add(r["score"])
        assert 0 <= r["score"] <= 1
    assert all(len(s) == 1 for s in by_text.values())
    assert quality_classifier.classify(docs.limit(0), labels).collect() == []


def test_label_of_a_held_out_document_has_no_say(spark):
    rows = [(i, ("good words " if i % 2 else "$$$ ### ") * (i % 7 + 3)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def scores(flip):
        labels = []
        for i, _ in rows:
            held = zlib.crc32(str(i).encode()) % 3 == 1
            labels.append((i, (i % 2) ^ int(held and flip)))
        out = quality_classifier.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        return {r["doc_id"]: r["score"] for r in out.collect()}

    assert scores(False) == scores(True)


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for k in range(len(words) - 2):
        places.setdefault(tuple(words[k : k + 3]), []).append(k)
    inside = {k + j for ks in places.values() if len(ks) > 1 for k in ks for j in range(3)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(inside))


def test_statistics_match_brute_force():
    texts = [None, "", " \x0b\x0c", "a b c a b c", "x x x x", "é ß ü\nline\nline\n \n \nline ", "a # * $ % & | < >", "a b a b a b\na b a b a b"]
    for text in texts + ["w " * 5000]:
        assert rules.statistics_of(text)[:5] == plain_statistics(text)


def test_a_learned_list_rejects_what_is_marked_bad(spark):
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(600):
        words = [f"w{rng.integers(0, 10**6)}" for _ in range(80)]
        bad = i % 4 == 0
        if bad:
            words = [w + "$#" for w in words] if i % 8 else [w.upper() for w in words]
        texts.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame([*texts, (None, None), (700, "short"), (700, "short")], "doc_id long, text string")
    out, learned = rules.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = out.collect()
    assert len(rows) == 603 and learned
    for r in rows:
        if r["doc_id"] is None or r["doc_id"] == 700:
            assert r["base_failed"] and not r["kept"]
        else:
            assert r["kept"] == (r["doc_id"] % 4 != 0)


def test_rules_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "w " * 60), (2, " ".join(map(str, range(60))))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out, learned = rules.judged(docs, none)
    assert learned == [] and {r["doc_id"]: r["kept"] for r in out.collect()} == {1: False, 2: True}
    assert rules.judged(docs.limit(0), none)[0].collect() == []


def test_learning_prunes_to_conditions_that_hold_on_other_rows():
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({name: rng.random(900) for name in rules.RATIOS})
    frame["label"] = (frame["symbols_per_char"] <= 0.7).astype(int)
    learned = rules.learn_rules(frame)
    # A rule may cut the same ratio twice, first at a coarse quantile and then closer.
    assert {c.ratio for c in learned[0]} == {"symbols_per_char"} and abs(learned[0][-1].cut - 0.7) < 0.05


def test_query_statistics(spark, sf_dir):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in rules.op5_decision_list(spark, sf_dir).collect():
        want = plain_statistics(texts[r["doc_id"]])
        assert tuple(r[n] for n in rules.BASE) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_long_documents_are_judged_by_all_of_their_text(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = docs.where(quality_classifier.id_remainder("doc_id", 3) == 1).join(labels, "doc_id").orderBy("doc_id").toPandas()
    held["bytes"] = held["text"].str.encode("utf-8").str.len()
    made, rng = [], np.random.default_rng(7)
    for quality in (0, 1):
        texts = held[held["quality"] == quality]["text"].tolist()
        for size in (30_000, 100_000, 300_000):
            for _ in range(12):
                text = ""
                while len(text) < size:
                    text += texts[rng.integers(len(texts))] + "\n"
                made.append((-1 - len(made), text, quality, size))
    joined = pd.DataFrame(made, columns=["doc_id", "text", "quality", "size"])
    rows = docs.union(spark.createDataFrame(joined[["doc_id", "text"]], "doc_id long, text string"))
    got = quality_classifier.classify(rows, labels).select("doc_id", "predicted", "score").toPandas()
    both = joined.merge(got, on="doc_id")
    print(both.groupby(["size", "quality"])["predicted"].agg(["mean", "count"]))
    own = held.merge(got, on="doc_id")
    own["band"] = pd.cut(own["bytes"], [-1, 500, 2_000, 8_000, 1 << 40]).astype(str)
    print(own.groupby(["band", "quality"])["predicted"].agg(["mean", "count"]))
    print("auc", auc(own["score"], own["quality"]))
    for size in (30_000, 100_000, 300_000):
        part = both[both["size"] == size]
        assert part[part["quality"] == 0]["predicted"].mean() < 0.1
        assert part[part["quality"] == 1]["predicted"].mean() > 0.9
    assert own[(own["bytes"] > 8_000) & (own["quality"] == 0)]["predicted"].mean() < 0.2
