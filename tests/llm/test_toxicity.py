from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from riskspark.llm import toxicity
from tests.llm.test_quality_and_rules import auc


@pytest.fixture(scope="module")
def model():
    words = {"idiot": 50, "stupid": 50, "the": 900, "moron": 40, "loser": 40, "ring": 200, "hello": 99, "trash": 40, "dust": 80}
    grams: dict[str, int] = {}
    for word, n in words.items():
        padded = f"^^{word}$"
        for i in range(len(padded) - 2):
            grams[padded[i : i + 3]] = grams.get(padded[i : i + 3], 0) + n
    return toxicity.LanguageModel(grams)


@pytest.mark.parametrize(
    ("written", "word"),
    [("1d10t", "idiot"), ("stup!d", "stupid"), ("i-d-i-o-t", "idiot"), ("iiidiooot", "idiot"), ("m0r0n", "moron"),
     ("l.o.s.e.r", "loser"), ("7r@5h", "trash"), ("stuuupid", "stupid"), ("h3lllo", "hello")],
)
def test_decodes_disguised_words(model, written, word):
    assert word in toxicity.restore(written, model)


def test_plain_words_stay(model):
    assert toxicity.restore("Dust,", model) == ["dust"]
    assert toxicity.restore("2024", model) == [] and toxicity.restore("--", model) == []


@pytest.mark.parametrize(
    ("written", "word"),
    [("$tupid", "stupid"), ("!diot", "idiot"), ("a$$", "ass"), ("@$$", "ass"), ("worthle$$", "worthless"), ("\"$tupid\"!", "stupid")],
)
def test_decodes_symbols_at_the_edges(written, word):
    grams: dict[str, int] = {}
    for known in ("stupid", "idiot", "ass", "worthless", "as", "the"):
        padded = f"^^{known}$"
        for i in range(len(padded) - 2):
            grams[padded[i : i + 3]] = grams.get(padded[i : i + 3], 0) + 50
    assert word in toxicity.restore(written, toxicity.LanguageModel(grams))


def test_numbers_are_read_too(model):
    assert toxicity.readings("7045", model) == ["toas"]
    assert toxicity.readings("--", model) == []


def test_spaced_letters_are_joined():
    assert toxicity.spaced("you s t u p i d thing") == ["stupid"]
    assert toxicity.spaced("i.d.i.o.t") == ["idiot"]
    assert toxicity.spaced("a plain text is not one") == []


def test_fast_readings_equal_plain_ones(model):
    """Plain words take a short way and spaced words are looked for only where some can be: both change no value."""
    rng = random.Random(2)
    lexicon = {"=idiot": 4.0, "idio": 2.0, "=moron": 3.5, "=loser": 3.0, "stup": 2.5, "=as": 1.6, "=hello": 1.0, "trash": 2.0, "=i": 1.5}
    reader = toxicity.TextReader(model.three, lexicon)
    reader.model = model
    pool = "idiotmornlseaIO10@$!.-_*(),'\"é  "
    words = ["idiot", "i", "d", "m0ron", "i.d", "i.d.i.o.t", "l-o", "s", "e!", "stupidly", "hellllo", "hhello", "trashy,", "(as)", "a_b", "\u200bidiot"]

    def plain_weight(word):
        best = max((lexicon.get(f, 0.0) for f in toxicity.features(word)), default=0.0)
        squeezed = {re.sub(r"(.)\1+", r"\1", f[1:]): w for f, w in lexicon.items() if f[0] == "=" and len(f) > 4}
        if not best and re.search(r"(.)\1+", word):
            best = squeezed.get(re.sub(r"(.)\1+", r"\1", word), 0.0)
        return best

    for _ in range(3000):
        text = " ".join(rng.choice(words) if rng.random() < 0.7 else "".join(rng.choices(pool, k=5)) for _ in range(rng.randint(0, 8)))
        chunks = text.split()
        want = [max(map(plain_weight, toxicity.readings(c, model)), default=0.0) for c in chunks]
        joined = [plain_weight(toxicity.decode(toxicity.plain(s), model)) for s in toxicity.spaced(text)]
        total, most, mean, hits = reader.measure(text)[0]
        every = want + [w for w in joined if w]
        assert most == max(every, default=0.0) and total == pytest.approx(np.log1p(sum(every))), text
        assert hits == pytest.approx(np.log1p(sum(w >= 3 for w in every)))
        assert mean == pytest.approx(sum(every) / (len(chunks) + 20))


def test_trigrams_of_words_of_any_length(spark):
    long = "abc" * 400_000
    texts = ["The the Ring", None, "", "éa 漢字 x2y -", "Σίγμα " * 3, long]
    docs = spark.createDataFrame([(t, "x") for t in texts], "text string, g string")
    want: dict[str, int] = {}
    for text in texts:
        for word in (text or "").lower().split():
            if word.isalpha():
                padded = f"^^{word}$"
                for i in range(len(padded) - 2):
                    want[padded[i : i + 3]] = want.get(padded[i : i + 3], 0) + 1
    assert toxicity.corpus_trigrams(docs, "text") == want
    assert toxicity.corpus_trigrams(docs.limit(0), "text") == {}


def toxic_corpus(n=240):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(n):
        words = [f"wo{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (40, 2))]
        bad = i % 3 == 0
        if bad:
            words[5:5] = ["idiot"] * 2 + ["moron"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_restored_text_is_scored(spark):
    rows, labels = toxic_corpus()
    clean = rows[1][1]
    extra = [(1000, clean + " 1d10t m0ron"), (1001, clean + " i d i o t"), (1002, clean + " iiidiooot"), (1003, clean)]
    extra += [(1004, None), (1005, ""), (None, "idiot"), (1006, "idiot " * 20_000), (1003, clean), (1007, "zq" * 500_000), (1008, "1$" * 50_000)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string")
    out = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    score = {r["doc_id"]: r["score"] for r in out}
    assert len(out) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in out)
    for i in (1000, 1001, 1002, 1006):
        assert score[i] > 0.5 > score[1003]
    assert score[1004] == score[1005] < 0.5
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert held and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held)


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score_toxicity(docs, none).collect()] == [0.5]
    assert toxicity.score_toxicity(docs.limit(0), none).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    got = toxicity.op2_noisy_channel_toxicity(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert len(got) == 10_000 and auc(held["score"], held["toxic"]) > 0.9
    assert (held["predicted"] == held["toxic"]).mean() > 0.95


def test_long_documents_are_scored_by_windows(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = docs.where(toxicity.id_remainder("doc_id", 5) == 0).join(labels, "doc_id").orderBy("doc_id").toPandas()
    kinds = [held[held["toxic"] == y]["text"].tolist() for y in (0, 1)]
    rng, made = np.random.default_rng(3), []
    for size, times in ((30_000, 12), (100_000, 12), (300_000, 8), (1_000_000, 4)):
        for k in range(2 * times):
            parts, length, used = [], 0, set()
            while length < size:
                at = int(rng.integers(len(kinds[0])))
                used.add(at)
                parts.append(kinds[0][at])
                length += len(parts[-1])
            if k % 2:
                parts.insert(rng.integers(len(parts) + 1), kinds[1][rng.integers(len(kinds[1]))])
            made.append((-1 - len(made), "\n".join(parts), k % 2, size, used))
    joined = pd.DataFrame(made, columns=["doc_id", "text", "toxic", "size", "used"])
    rows = docs.union(spark.createDataFrame(joined[["doc_id", "text"]], "doc_id long, text string"))
    got = toxicity.score_toxicity(rows, labels).select("doc_id", "predicted", "score").toPandas()
    both = joined.merge(got, on="doc_id")
    print(both.groupby(["size", "toxic"])["predicted"].agg(["mean", "sum", "count"]))
    own = held.merge(got, on="doc_id")
    own["band"] = pd.cut(own["text"].str.len(), [-1, 500, 2_000, 8_000, 1 << 40]).astype(str)
    print(own.groupby(["band", "toxic"])["predicted"].agg(["mean", "sum", "count"]))
    print("auc", auc(own["score"], own["toxic"]))
    # A clean text that is flagged by itself is flagged inside a longer one too; length adds nothing to it.
    alone = own[own["toxic"] == 0]["predicted"].tolist()
    both["flagged"] = [any(alone[i] for i in u) for u in both["used"]]
    clean, toxic = both[(both["toxic"] == 0) & ~both["flagged"]], both[both["toxic"] == 1]
    print("clean parts only", len(clean), int(clean["predicted"].sum()))
    assert len(clean) > 20 and clean["predicted"].mean() < 0.05 and toxic["predicted"].mean() > 0.85
