"""Token ids in wavelet matrices: one compressed file per shard, searchable as it lies.

A wavelet matrix holds a sequence as one bit plane per bit of its symbols, most significant first; each plane
moves symbols with bit 0 before those with bit 1, keeping their order. With counts of ones per block, a token is read,
counted or found in one step per plane.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskspark.llm.bpe import Encoder, Vocabulary
from riskspark.llm.chunks import PackedTable, blocks, coded_pieces
from riskspark.llm.common import small_batches, stored, table, worker_memory
from riskspark.session import new_scratch_path

MAGIC = b"WAVELET1"
#: A shard is closed when it has so many ids; a document is never split.
SHARD_TOKENS = 1 << 22
#: Ids below this are ranked by a table of all of them, others by sorting.
PRESENCE = 1 << 24
#: Ids that are ranked together.
PART = 1 << 18
#: Distinct pieces a worker remembers here; they are packed, so more than ``chunks.MEMORY``.
PIECES = 1_500_000
#: Bytes of texts whose pieces are looked up together.
TOGETHER = 1 << 25
#: Ids that are moved together, as their positions stay in the processor's cache.
MOVED = 1 << 15
#: Bits between two entries of a plane's count directory.
BLOCK = 512
SUFFIX = ".wavelet"


class WaveletMatrix:
    """Access, rank and select over a sequence of ids."""

    def __init__(self, symbols: np.ndarray, n: int, planes: list[np.ndarray], zeros: list[int]):
        #: Sorted distinct ids; planes hold their ranks.
        self.symbols, self.n, self.planes, self.zeros = symbols, n, planes, zeros
        self.depth = len(planes)
        self.counts = []
        for plane in planes:
            padded = np.zeros(-(-len(plane) * 8 // BLOCK) * BLOCK // 8, np.uint8)
            padded[: len(plane)] = plane
            ones = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
            self.counts.append(np.concatenate(([0], np.cumsum(ones))))

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        if len(ids) and ids.max() < PRESENCE:
            # Parts of the sequence, as ids become positions of 64 bits on the way.
            parts = [slice(a, a + PART) for a in range(0, len(ids), PART)]
            present = np.zeros(int(ids.max()) + 1, bool)
            for part in parts:
                present[ids[part]] = True
            symbols = np.flatnonzero(present).astype(ids.dtype)
            rank_of = (np.cumsum(present) - 1).astype(np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
            ranks = np.empty(len(ids), rank_of.dtype)
            for part in parts:
                ranks[part] = rank_of[ids[part]]
        else:
            symbols, ranks = np.unique(ids, return_inverse=True)
            ranks = ranks.astype(np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
        planes, zeros = [], []
        for bit in reversed(range(max(1, int(len(symbols) - 1).bit_length()) if len(symbols) else 0)):
            ones = (ranks >> bit) & 1 == 1
            planes.append(np.packbits(ones))
            zeros.append(len(ranks) - int(np.count_nonzero(ones)))
            moved = np.empty_like(ranks)
            for part, low, high, to_low, to_high in _moves(ones, zeros[-1]):
                moved[to_low], moved[to_high] = ranks[part][low], ranks[part][high]
            ranks = moved
        return cls(symbols, len(ids), planes, zeros)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        plane, block = self.planes[level], at // BLOCK
        out = self.counts[level][block].copy()
        first = block * (BLOCK // 8)
        for k in range(BLOCK // 8):
            byte = first + k
            whole = (byte + 1) * 8 <= at
            part = ~whole & (byte * 8 < at)
            inside = np.minimum(byte, max(len(plane) - 1, 0))
            out[whole] += np.bitwise_count(plane[inside[whole]]).astype(np.int64)
            cut = plane[inside[part]] >> (8 - (at[part] - byte[part] * 8)).astype(np.uint8)
            out[part] += np.bitwise_count(cut).astype(np.int64)
            if not whole.any():
                break
        return out

    def access(self, at) -> np.ndarray:
        """The ids at the given positions."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("position outside the sequence")
        rank = np.zeros(len(at), np.int64)
        for level, plane in enumerate(self.planes):
            bit = (plane[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            ones = self._ones(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            rank = rank * 2 + bit
        return self.symbols[rank]

    def _range(self, symbol: int, end: int) -> tuple[int, int] | None:
        """The stretch of the last order that holds the symbol's occurrences before ``end``."""
        code = int(np.searchsorted(self.symbols, symbol))
        if code == len(self.symbols) or self.symbols[code] != symbol:
            return None
        low, high = 0, end
        for level in range(self.depth):
            a, b = self._ones(level, np.array([low, high])).tolist()
            if code >> (self.depth - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, symbol: int, end: int) -> int:
        """Occurrences of an id before position ``end``."""
        found = self._range(symbol, min(max(end, 0), self.n))
        return found[1] - found[0] if found else 0

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) zeros or ones of a plane."""
        counts = self.counts[level]
        if not bit:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = np.searchsorted(counts, k, side="right") - 1
        out = np.empty(len(k), np.int64)
        for i, (b, rest) in enumerate(zip(block.tolist(), (k - counts[block]).tolist())):
            bits = np.unpackbits(self.planes[level][b * BLOCK // 8 : (b + 1) * BLOCK // 8])
            out[i] = b * BLOCK + np.flatnonzero(bits == bit)[rest]
        return out

    def select(self, symbol: int, k) -> np.ndarray:
        """Positions of the k-th occurrences (from 0) of an id; k must be below its count."""
        k = np.atleast_1d(np.asarray(k, np.int64))
        found = self._range(symbol, self.n)
        if found is None or len(k) and (k.min() < 0 or k.max() >= found[1] - found[0]):
            raise IndexError("the id does not occur so often")
        at, code = found[0] + k, int(np.searchsorted(self.symbols, symbol))
        for level in reversed(range(self.depth)):
            bit = code >> (self.depth - 1 - level) & 1
            at = self._select(level, bit, at - (self.zeros[level] if bit else 0))
        return at

    def all(self) -> np.ndarray:
        """The whole sequence, by undoing the moves of every plane from the last."""
        kind = np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32
        ranks = np.zeros(self.n, kind)
        for level in reversed(range(self.depth)):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            ranks[self.zeros[level] :] |= kind(1 << (self.depth - 1 - level))
            moved = np.empty_like(ranks)
            for part, low, high, from_low, from_high in _moves(ones, self.zeros[level]):
                back = moved[part]
                back[low], back[high] = ranks[from_low], ranks[from_high]
            ranks = moved
        return self.symbols[ranks]


def _moves(ones: np.ndarray, zeros: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, slice, slice]]:
    """How a plane moves its ids, part by part: the part, its positions with bit 0 and 1, and where they go.

    By position, as a choice by mask takes several times as long where bits are mixed.
    """
    a, b = 0, zeros
    for first in range(0, len(ones), MOVED):
        part = slice(first, min(first + MOVED, len(ones)))
        low, high = np.flatnonzero(~ones[part]), np.flatnonzero(ones[part])
        yield part, low, high, slice(a, a + len(low)), slice(b, b + len(high))
        a, b = a + len(low), b + len(high)


def pack(documents: pa.Table, matrix: WaveletMatrix) -> bytes:
    """One shard as bytes: magic, part lengths, the documents as an Arrow stream, ids, zero counts, planes.

    ``documents`` has the columns ``id`` and ``n_tokens``, and the shard's number in its metadata. Every part is one zstandard frame.
    """
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as stream:
        stream.write_table(documents)
    small = np.array([matrix.n, *matrix.zeros], "<i8").tobytes()
    parts = [sink.getvalue().to_pybytes(), small, matrix.symbols.astype("<u4").tobytes()]
    frames = [zstandard.ZstdCompressor(level=1).compress(p) for p in parts + [p.tobytes() for p in matrix.planes]]
    return MAGIC + np.array([len(frames), *map(len, frames)], "<i8").tobytes() + b"".join(frames)


def unpack(raw: bytes) -> tuple[pa.Table, WaveletMatrix]:
    if raw[:8] != MAGIC:
        raise ValueError("not a wavelet shard")
    n = int(np.frombuffer(raw[8:16], "<i8")[0])
    sizes = np.frombuffer(raw[16 : 16 + 8 * n], "<i8").tolist()
    at, parts = 16 + 8 * n, []
    for size in sizes:
        parts.append(zstandard.ZstdDecompressor().decompress(raw[at : at + size]))
        at += size
    documents = pa.ipc.open_stream(parts[0]).read_all()
    small = np.frombuffer(parts[1], "<i8").tolist()
    planes = [np.frombuffer(p, np.uint8) for p in parts[3:]]
    return documents, WaveletMatrix(np.frombuffer(parts[2], "<u4"), small[0], planes, small[1:])


def _write(folder: str, name: str, content: bytes) -> None:
    """Put a file in its place in one step, so that a task that is run again replaces it by the same."""
    if "://" in folder or folder.startswith("file:"):
        store, root = pafs.FileSystem.from_uri(folder)
    else:
        store, root = pafs.LocalFileSystem(), folder
    store.create_dir(root, recursive=True)
    draft = f"{root}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(content)
    store.move(draft, f"{root}/{name}")


def library_resolver(source: str) -> Callable[[list[bytes]], pa.ListArray]:
    """Ids of text pieces by the tokenizers library.

    Its model is asked once for each distinct word; words are split by the pattern of the tokenizer file. That
    this gives the ids of its ``encode`` on whole texts is tested.
    """
    vocabulary = Vocabulary(source)
    return Encoder(vocabulary, merge=vocabulary.library_merge).resolve_all


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode all texts in ascending order of id and write them as wavelet files; returns the manifest.

    ``tokenizer`` is the content of a tokenizer file whose words never join across white space. Rows are dealt out by
    ranges of id and text hash, so equal ids are split too; null ids come first; null and empty texts are just ``end_id``;
    repeated rows are all written; an empty table writes no file. The manifest has ``part``, ``shard``, ``n_docs`` and ``n_tokens``.
    """
    source = docs.sparkSession.sparkContext.broadcast(tokenizer)
    small_batches(docs.sparkSession)
    mark = hashlib.sha1(tokenizer.encode()).hexdigest()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    order = ("id", F.xxhash64("text"), "text")
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions(*order)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pieces = worker_memory(
            ("library", mark), lambda: PackedTable(library_resolver(source.value), PIECES)
        )
        ids: list[np.ndarray] = []
        keys: list[pa.Array] = []
        held, number = 0, 0
        # Blocks that wait for the ids of their pieces: keys, pieces as numbers, where each text's pieces begin.
        waiting: list[tuple[pa.Array, pa.DictionaryArray, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            lengths = pa.array([len(x) for x in ids], pa.int64())
            documents = pa.table({"id": pa.chunked_array(keys).combine_chunks(), "n_tokens": lengths})
            documents = documents.replace_schema_metadata({"part": str(part), "shard": str(number)})
            name = f"part-{part:06d}-{number:06d}{SUFFIX}"
            _write(folder, name, pack(documents, WaveletMatrix.build(np.concatenate(ids))))
            made = {"part": [part], "shard": [number], "n_docs": [len(ids)], "n_tokens": [held]}
            return pa.RecordBatch.from_pydict(made)

        def encoded() -> Iterator[pa.RecordBatch]:
            nonlocal ids, keys, held, number, size
            places = pieces.encode([codes for _, codes, _ in waiting])
            for (names, _, bounds), at in zip(waiting, places):
                found, offsets = pieces.expanded(at, bounds)
                for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                    ids.append(np.append(found[a:b], np.uint32(end_id)))
                    keys.append(names.slice(row, 1))
                    held += len(ids[-1])
                    if held >= SHARD_TOKENS:
                        yield close()
                        ids, keys, held, number = [], [], 0, number + 1
            waiting.clear()
            size = 0
            pa.default_memory_pool().release_unused()

        for batch in batches:
            row = 0
            # A copy, as a part of the batch would keep its texts.
            names = batch.column(0).take(pa.array(np.arange(len(batch))))
            for block in blocks(batch.column(1)):
                waiting.append((names.slice(row, len(block)), *coded_pieces(block)))
                row += len(block)
                size += block.nbytes
                if size >= TOGETHER:
                    yield from encoded()
        if waiting:
            yield from encoded()
        if ids:
            yield close()

    manifest = "part long, shard long, n_docs long, n_tokens long"
    return stored(rows.mapInArrow(shards, manifest), "wavelet-manifest")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{folder}/*{SUFFIX}").select("content")


def read_shards(spark: SparkSession, folder: str, manifest: DataFrame, id: StructField) -> DataFrame:
    """Documents of the files: their id, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32``."""
    schema = StructType(
        [
            *StructType.fromDDL("part long, shard long").fields,
            StructField(id.name, id.dataType),
            *StructType.fromDDL("before long, n_tokens long, ids_crc32 long").fields,
        ]
    )
    kinds = [StructField("start", LongType()), *schema.fields[-2:]]
    # One number per partition of the writing job.
    totals = {r[0]: r[1] for r in manifest.groupBy("part").agg(F.sum("n_tokens")).collect()}
    if not totals:
        return spark.createDataFrame([], StructType([schema[id.name], *kinds]))
    parts = sorted(totals)
    before = np.concatenate(([0], np.cumsum([totals[p] for p in parts])))[:-1].tolist()
    bases = spark.createDataFrame(list(zip(parts, before)), "part long, base long")
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("inner", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    shards = shards.join(bases, "part").select("part", "shard", (F.col("base") + F.col("inner")).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                docs, matrix = unpack(content.as_py())
                ids = matrix.all().astype("<u4")
                lengths = docs["n_tokens"].to_numpy()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                meta = docs.schema.metadata
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(meta[b"part"])] * n, pa.int64()),
                        pa.array([int(meta[b"shard"])] * n, pa.int64()),
                        docs["id"].combine_chunks(),
                        pa.array(starts),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    schema.names,
                )

    rows = _files(spark, folder).mapInArrow(documents, schema)
    return rows.join(shards, ["part", "shard"]).select(
        id.name, (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """Where an id occurs, file by file: ``part``, ``shard``, ``position``; only its own planes' counts are walked."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                docs, matrix = unpack(content.as_py())
                n, meta = matrix.rank(token, matrix.n), docs.schema.metadata
                if n:
                    at = matrix.select(token, np.arange(n))
                    part, shard = int(meta[b"part"]), int(meta[b"shard"])
                    yield pa.RecordBatch.from_pydict({"part": [part] * n, "shard": [shard] * n, "position": at})

    return _files(spark, folder).mapInArrow(found, "part long, shard long, position long")


def op8_wavelet_shards(spark, sf_dir):
    """All documents written as wavelet files and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    folder = new_scratch_path(spark, "wavelet")
    manifest = write_shards(docs, folder, tokenizer, end_id=2)
    return read_shards(spark, folder, manifest, docs.schema["doc_id"])


QUERIES = {"op8_wavelet_shards": op8_wavelet_shards}
ORACLES: dict[str, str] = {}
