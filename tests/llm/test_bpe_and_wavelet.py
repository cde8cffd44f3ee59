from __future__ import annotations

import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from riskspark.llm import bpe, wavelet  # noqa: E402
from riskspark.llm.chunks import ChunkTable, PackedTable, coded_pieces  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
POOL = (
    "abcXYZ éÉüßñçÑΣσς İıſK Å ① ½ ² ٣ ५ あ漢字 한글 é ́̈ ’'s'S're've'm'll'd'T _-!?.,$$%%&& "
    "\x1c\x1d\x1e\x1f\x85\xa0 ​᠎ \t\n\r\x0b\x0c 🙂👍🏽 ﬁ Ǆ ǅ ͅ <|startoftext|> <|endoftext|> <|"
)
EDGES = [(3, None), (1, ""), (2, "Hello, <|endoftext|> World 12"), (2, "same id"), (None, "null id"), (9, "rep"), (9, "rep"), (5, "very long text! " * 20_000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(PATH)


def test_encoding_and_decoding_match_the_library(library, vocabulary):
    rng = random.Random(5)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += [f"{t}<|endoftext|>{t}" for t in texts[:200]] + ["=" * 300, "lorem" * 60, "!" * 99 + "$" * 99]
    texts += ["a%sb" % chr(i) for i in range(1, 0x3000)]
    lexicon = {w.encode(): vocabulary.merge(w.encode()) for w in ("abc", "a", "b", "lorem", "é", "hello")}
    for transducer in (None, bpe.Transducer.compile(lexicon), bpe.Transducer.compile({})):
        pieces = ChunkTable(bpe.Encoder(vocabulary, transducer).resolve, memory=500)
        for text, ids in zip(texts, pieces.encode(t.encode() for t in texts)):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want
            assert bpe.decode(vocabulary, ids).decode() == library.decode(want, skip_special_tokens=False)


def test_transducer_is_minimal_and_survives_its_file(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "x"])}
    t = bpe.Transducer.compile(words)
    # A minimal automaton has one state for each different set of endings of a prefix.
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(t.final) == len(endings)
    t.save(str(tmp_path / "lexicon"))
    back = bpe.Transducer.load(str(tmp_path / "lexicon"))
    assert isinstance(back.keys.base, np.memmap) or isinstance(back.keys, np.memmap)
    ranks = back.ranks([*words, b"to", b"", b"topss", b"y"])
    assert ranks[-4:].tolist() == [-1] * 4
    for word, rank in zip(words, ranks):
        assert back.ids[back.starts[rank] : back.starts[rank + 1]].tolist() == words[word]


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_documents(spark, library, vocabulary):
    df = spark.createDataFrame([(i, t, "x") for i, t in EDGES], "doc_id long, text string, n_tokens string")
    out = bpe.encode_documents(df, vocabulary, size=4, keep_ids=True).collect()
    want = {}
    for i, t in EDGES:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.setdefault(i, []).append((len(ids), digest(ids), ids, library.decode(ids, skip_special_tokens=False)))
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_sha256"], r["ids"], r["decoded"]))
        assert hashlib.sha256(r["decoded"].encode()).hexdigest() == r["decoded_sha256"]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert bpe.encode_documents(df.limit(0), vocabulary).collect() == []


@pytest.mark.parametrize(("n", "kinds"), [(0, 5), (1, 3), (1000, 1), (5000, 300), (3000, 70_000)])
def test_wavelet_matrix(n, kinds):
    x = np.random.default_rng(1).integers(0, kinds, n).astype(np.uint32)
    table = pa.table({"id": [1], "n_tokens": [n]}).replace_schema_metadata({"part": "0", "shard": "0"})
    _, w = wavelet.unpack(wavelet.pack(table, wavelet.WaveletMatrix.build(x)))
    assert (w.all() == x).all() and (w.access(np.arange(n)) == x).all()
    for symbol in x[:20].tolist():
        at = np.flatnonzero(x == symbol)
        assert (w.select(symbol, np.arange(len(at))) == at).all()
        for end in (0, 1, n // 3, 511, 512, 513, n):
            assert w.rank(symbol, end) == (x[:end] == symbol).sum()
    assert w.rank(999_999, n) == 0
    with pytest.raises(IndexError):
        w.select(999_999, 0)


def test_control_characters_have_the_ids_of_the_library(library):
    """Also in words of ASCII only, where no byte but a printable one stands for itself."""
    texts = [f"a{chr(i)}b {chr(i)}" for i in (*range(1, 9), *range(14, 32), 127)] + ["a\0b"]
    table = ChunkTable(wavelet.library_resolver(open(PATH).read()))
    got = [ids.tolist() for ids in table.encode(t.encode() for t in texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_worker_writing_shards_resolves_many_pieces_once(spark, monkeypatch, tmp_path):
    """What a worker has seen in 350,000 other pieces is known when it comes again."""
    asked = tmp_path / "asked"
    asked.mkdir()

    def resolver(source):
        def resolve(pieces):
            (asked / str(len(list(asked.iterdir())))).write_text(str(len(pieces)))
            return [[int(p)] for p in pieces]

        return resolve

    monkeypatch.setattr(wavelet, "library_resolver", resolver)
    numbers = [" ".join(map(str, range(a, a + 50_000))) for a in [*range(0, 350_000, 50_000)] * 2]
    df = spark.createDataFrame(list(enumerate(numbers)), "doc_id long, text string").coalesce(1)
    folder = wavelet.new_scratch_path(spark, "wavelet-test")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        manifest = wavelet.write_shards(df, folder, "another tokenizer", 400_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert manifest.agg({"n_tokens": "sum"}).first()[0] == 14 * 50_001
    assert sum(int(f.read_text()) for f in asked.iterdir()) == 350_000
    out = wavelet.read_shards(spark, folder, manifest, df.schema["doc_id"]).collect()
    want = [zlib.crc32(np.array([*map(int, t.split()), 400_000], "<u4").tobytes()) for t in numbers]
    assert [r["ids_crc32"] for r in sorted(out, key=lambda r: r["doc_id"])] == want


def packed(table, texts):
    """Ids of each text by one call of the table, two texts a block."""
    codes = [coded_pieces(pa.array(texts[i : i + 2])) for i in range(0, len(texts), 2)]
    out = []
    for (_, bounds), at in zip(codes, table.encode([c for c, _ in codes])):
        ids, offsets = table.expanded(at, bounds)
        out += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    return out


def test_pieces_resolved_together_have_the_ids_of_the_library(library):
    rng = random.Random(6)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    texts += ["a%sb" % chr(i) for i in range(1, 0x3000)]
    texts += [f"ab{t}<|endoftext|>É{t}" for t in texts[:99]] + ["", " ", "<a <b> ΑΣ ΣΑΣ. ΌΣΟΣ", "<|endoftext|>", "e\u0301\u0327 \u0301"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    source = open(PATH).read()
    assert packed(PackedTable(wavelet.library_resolver(source), 1 << 20), texts) == want
    # Without code points that are in no table of this Python, others than ASCII are split together.
    known = [i for i, t in enumerate(texts) if all(unicodedata.category(c) != "Cn" for c in t)]
    table = PackedTable(wavelet.library_resolver(source), 1 << 20)
    assert packed(table, [texts[i] for i in known]) == [want[i] for i in known]
    assert wavelet.library_resolver(source)([]).to_pylist() == []


def test_a_packed_table_forgets_and_answers_alike():
    def resolve(pieces):
        return [[len(p), *p] for p in pieces]

    rng = random.Random(7)
    for memory, length in ((20, 3), (1000, 3), (20, 200)):
        table = PackedTable(resolve, memory)
        for _ in range(60):
            texts = [" ".join("abc"[rng.randrange(3)] * rng.randint(1, length) for _ in range(rng.randint(1, 9))) for _ in range(5)]
            want = [[i for p in t.split(" ") for i in (len(p), *p.encode())] for t in texts]
            assert packed(table, texts) == want
            # What one call asks for, and half of the memory.
            assert len(table.names) <= memory // 2 + 45
            assert table.ids.nbytes <= memory * PackedTable.PIECE_BYTES // 2 + 45 * 4 * (length + 1) or len(table.names) <= memory
    with pytest.raises(ValueError):
        packed(PackedTable(lambda pieces: [[1]], 9), ["a b"])


def test_a_worker_writing_shards_remembers_a_million_pieces(spark, monkeypatch):
    """What a worker has seen in 900,000 other pieces is known when it comes again."""
    asked = spark.sparkContext.accumulator(0)

    def resolver(source):
        def resolve(pieces):
            asked.add(len(pieces))
            return [[int(p)] for p in pieces]

        return resolve

    monkeypatch.setattr(wavelet, "library_resolver", resolver)
    monkeypatch.setattr(wavelet, "TOGETHER", 1 << 20, raising=False)
    numbers = [" ".join(map(str, range(a, a + 100_000))) for a in [*range(0, 900_000, 100_000)] * 2]
    df = spark.createDataFrame(list(enumerate(numbers)), "doc_id long, text string").coalesce(1)
    folder = wavelet.new_scratch_path(spark, "wavelet-test")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        manifest = wavelet.write_shards(df, folder, "a third tokenizer", 900_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert asked.value == 900_000
    out = wavelet.read_shards(spark, folder, manifest, df.schema["doc_id"]).collect()
    want = [zlib.crc32(np.array([*map(int, t.split()), 900_000], "<u4").tobytes()) for t in numbers]
    assert [r["ids_crc32"] for r in sorted(out, key=lambda r: r["doc_id"])] == want


@pytest.mark.parametrize(("n", "kinds"), [(wavelet.MOVED, 9), (3 * wavelet.MOVED + 5, 70_000)])
def test_planes_are_built_and_undone_part_by_part(n, kinds):
    x = np.random.default_rng(2).integers(0, kinds, n).astype(np.uint32)
    w = wavelet.WaveletMatrix.build(x)
    ranks = np.searchsorted(w.symbols, x)
    for level, plane in enumerate(w.planes):
        bit = ranks >> (w.depth - 1 - level) & 1
        assert (np.packbits(bit.astype(bool)) == plane).all() and w.zeros[level] == (bit == 0).sum()
        ranks = np.concatenate((ranks[bit == 0], ranks[bit == 1]))
    assert (w.all() == x).all()


@pytest.mark.parametrize("limit", [1 << 22, 50])
def test_shards_keep_order_and_places(spark, library, monkeypatch, limit):
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", limit)
    df = spark.createDataFrame([(i, t, 1) for i, t in EDGES], "doc_id long, text string, start int")
    folder = wavelet.new_scratch_path(spark, "wavelet-test")
    with open(PATH) as file:
        manifest = wavelet.write_shards(df, folder, file.read(), 2)
    out = wavelet.read_shards(spark, folder, manifest, df.schema["doc_id"]).collect()
    rows = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 2, 3, 5, 9, 9]
    at, known = 0, {}
    for i, t in EDGES:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        known.setdefault(i, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in rows:
        assert r["start"] == at and (r["n_tokens"], r["ids_crc32"]) in known[r["doc_id"]]
        at += r["n_tokens"]
    ends = wavelet.occurrences(spark, folder, 2).count()
    assert ends >= len(EDGES)
    assert limit > 50 or manifest.count() > 1


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = wavelet.new_scratch_path(spark, "wavelet-test")
    with open(PATH) as file:
        manifest = wavelet.write_shards(df, folder, file.read(), 2)
    assert wavelet.read_shards(spark, folder, manifest, df.schema["doc_id"]).collect() == []
