from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from sentencepiece import SentencePieceProcessor  # noqa: E402

from riskspark.llm import pieces  # noqa: E402
from riskspark.llm.chunks import ChunkTable  # noqa: E402
from riskspark.llm.common import table  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
POOL = "abcdefghijklmnop   \n\n\t▁▁éÉ漢字🦄🙂\x00\x01.,!?()''-=====0123456789ABC<0x41></s>\x85\xa0́"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(PATH)


def test_encoding_and_decoding_match_the_library(library, model):
    rng = random.Random(4)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choice("aei thnrs") for _ in range(60)) for _ in range(2000)]
    texts += [c * k for c in (" ", "=", "▁", "a", "\n") for k in range(70)]
    texts += ["a" * 5000, " " * 3000 + "x" + " " * 77, "<s> </s> <0x0A> <unk>", "▁ ▁x▁ y"]
    encoder = pieces.PieceEncoder(model)
    parts = ChunkTable(encoder.resolve, memory=500, split=model.split)
    for text, ids in zip(texts, parts.encode(t.encode() for t in texts)):
        want = library.encode(text)
        assert ids.tolist() == want, text
        assert pieces.decode(model, [model.begin, *want, model.end]).decode() == library.decode(want)


def test_whole_texts_need_no_splitting(library, model):
    """The walk itself is exact on unsplit texts, so splitting only saves work."""
    rng = random.Random(6)
    encoder = pieces.PieceEncoder(model)
    for _ in range(300):
        text = "".join(rng.choice("the is ing qu ▁x=\n") for _ in range(rng.randint(1, 200)))
        assert encoder.encode("▁" + text.replace(" ", "▁")) == library.encode(text)


def test_failed_places_keep_the_walk_linear(model):
    encoder = pieces.PieceEncoder(model)
    rng = random.Random(7)
    text = "".join(rng.choice("abn") for _ in range(300_000))
    assert "".join(model.pieces[i] for i in encoder.encode(text)) == text


def test_pairs_are_forgotten_when_too_many(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "PAIRS", 20)
    encoder = pieces.PieceEncoder(model)
    text = "▁an▁extraordinarily▁long▁walk▁through▁seventeen▁unforgettable▁places"
    assert encoder.encode(text) == library.encode(text[1:].replace("▁", " "))


def test_edges(spark, model, library):
    rows = [
        (1, None, "a"),
        (2, "", "b"),
        (3, "Same id", "c"),
        (3, "Same id", "c"),
        (None, "null id\n", "d"),
        (4, "one very long text " * 20_000, "e"),
        (5, "x" * 200_000, "f"),
        (6, "   ", "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.encode_documents(docs, model)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    found = sorted((r["doc_id"] or 0, r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got.collect())
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc_id or 0, len(ids), np.array(ids, "<u4").tobytes(), text or ""))
    assert found == sorted(want)
    assert pieces.encode_documents(docs.limit(0), model).count() == 0


def test_query_equals_the_library(spark, sf_dir, library):
    got = pieces.op13_backtracking_pieces(spark, sf_dir)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "string", "string"]
    found = {r["doc_id"]: tuple(r)[1:] for r in got.collect()}
    want = {}
    for doc_id, text in table(spark, sf_dir, "documents", "doc_id", "text").collect():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        back = library.decode(ids)
        want[doc_id] = (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest(),
        )
    assert found == want
