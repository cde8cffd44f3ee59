"""Exact merge-type piece encoding by backtracking, and decoding.

A list of pieces is what merging gives if and only if merging any two neighbours alone gives these two again: no merge
crosses a border that stays, so the order of merges on both sides is that of the two alone. The encoder walks
a text from left to right: at each place it takes the longest piece that an Aho-Corasick automaton found there and that goes with
the piece before; if none does, the place is marked in a bit field as failed and the piece before is shortened. Each place fails
once at most, so the walk is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from riskspark.llm.chunks import ChunkTable, blocks, joined
from riskspark.llm.common import small_batches, table, worker_memory

#: The mark that stands for a blank inside pieces.
BLANK = "▁"
#: Pairs of pieces whose answer a worker remembers before it starts anew.
PAIRS = 1_000_000
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class PieceModel:
    """What a model file says: pieces, scores, byte pieces, begin and end ids."""

    def __init__(self, raw: bytes):
        from sentencepiece import sentencepiece_model_pb2 as format

        proto = format.ModelProto()
        proto.ParseFromString(raw)
        trainer, normalizer = proto.trainer_spec, proto.normalizer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("expected a BPE model with byte fallback and blanks before words")
        if normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces or not normalizer.escape_whitespaces:
            raise ValueError("expected a model that changes no text")
        kinds = [p.type for p in proto.pieces]
        if not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("expected a model without user-defined and unused pieces")
        self.raw = raw
        self.prefix = b" " if normalizer.add_dummy_prefix else b""
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        self.pieces = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        self.bytes = [i for i, k in enumerate(kinds) if k == BYTE]
        #: The text of each id; begin and end ids have none.
        self.texts = [p.replace(BLANK, " ").encode() if kinds[i] == NORMAL else b"" for i, p in enumerate(self.pieces)]
        for value, i in enumerate(self.bytes):
            self.texts[i] = bytes([value])
        self.splitter = self._splitter()

    def _splitter(self) -> re.Pattern | None:
        """Cuts a text where no piece goes across: before blanks, and around ASCII characters that are in no longer piece."""
        long = [p for p in self.ids if len(p) > 1]
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in long):
            return None
        inside = set("".join(long))
        alone = b"".join(re.escape(bytes([c])) for c in range(128) if chr(c) not in inside and c != 32)
        return re.compile(rb" *[^ %b]+| +|[%b]" % (alone, alone)) if alone else re.compile(rb" *[^ ]+| +")

    def split(self, text: bytes) -> list[bytes]:
        """The parts of a text that are encoded on their own; blanks are as in the text."""
        if not text:
            return []
        text = self.prefix + text.replace(BLANK.encode(), b" ")
        return self.splitter.findall(text) if self.splitter else [text]


class PieceEncoder:
    """Ids of parts of a text by backtracking over Aho-Corasick matches."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.size = [len(p) for p in model.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece, i in model.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        #: The longest shorter piece that a piece begins with, -1 for none.
        self.shorter = [-1] * len(model.pieces)
        for piece, i in model.ids.items():
            for n in range(len(piece) - 1, 0, -1):
                if (j := model.ids.get(piece[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.pairs: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """The parts of a short text by its merges: best score first, leftmost of equals."""
        ids, scores = self.model.ids, self.model.scores
        parts = list(text)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and scores[i] > best:
                    best, at = scores[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def together(self, left: int, right: int) -> bool:
        """Whether merging two pieces side by side gives these two again; ``left`` -1 asks for the piece alone."""
        key = left * len(self.size) + right
        known = self.pairs.get(key)
        if known is None:
            pieces = self.model.pieces
            two = [pieces[right]] if left < 0 else [pieces[left], pieces[right]]
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge("".join(two)) == two
        return known

    def encode(self, text: str) -> list[int]:
        """Ids of a part of a text; characters that no piece has become their bytes."""
        n = len(text)
        longest = [-1] * n
        for last, i in self.automaton.iter(text):
            # Matches come by their ends, so the longest of a place comes last.
            longest[last + 1 - self.size[i]] = i
        if n and (i := longest[0]) >= 0 and self.size[i] == n and self.together(-1, i):
            return [i]
        out: list[int] = []
        at = 0
        while at < n:
            if longest[at] < 0:
                out += map(self.model.bytes.__getitem__, text[at].encode())
                at += 1
                continue
            stop = at
            while stop < n and longest[stop] >= 0:
                stop += 1
            out += self._walk(longest, at, stop)
            at = stop
        return out

    def _walk(self, longest: list[int], start: int, stop: int) -> list[int]:
        """Ids of a stretch whose characters are all pieces themselves."""
        failed = bytearray(((stop - start) >> 3) + 1)
        size, shorter, pairs, together = self.size, self.shorter, self.pairs, self.together
        width = len(size)
        taken: list[int] = []
        at, piece, last = start, longest[start], -1
        while at < stop:
            while piece >= 0:
                place = at + size[piece] - start
                if at + size[piece] <= stop and not failed[place >> 3] >> (place & 7) & 1:
                    known = pairs.get(last * width + piece)
                    if known or known is None and together(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at += size[piece]
                last, piece = piece, longest[at] if at < stop else -1
            else:
                place = at - start
                failed[place >> 3] |= 1 << (place & 7)
                # Single characters always encode a text, so there is a piece to shorten.
                last = taken.pop()
                at -= size[last]
                piece = shorter[last]
                last = taken[-1] if taken else -1
        return taken

    def resolve(self, parts: list[bytes]) -> list[list[int]]:
        return [self.encode(p.decode("utf-8", "replace").replace(" ", BLANK)) for p in parts]


def decode(model: PieceModel, ids: list[int]) -> bytes:
    """The text that ids stand for, as UTF-8, without the blank put before it."""
    return b"".join(map(model.texts.__getitem__, ids)).removeprefix(model.prefix)


def encode_documents(docs: DataFrame, model: PieceModel, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens``, ``ids`` and ``decoded``.

    ``ids`` holds the ids of the whole text between the begin and the end id as little-endian unsigned 32-bit integers, the form
    token files have; ``decoded`` is the text decoded from them. Null and empty texts have the begin and end id only and decode
    to the empty text. Repeated rows and all other columns are kept as they are, those named as what is added are
    replaced; an empty table gives an empty one. A very long text, also one without blanks, is worked on as one value
    in time and memory linear in its length.
    """
    small_batches(docs.sparkSession)
    added = [StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded", StringType())]
    others = [c for c in docs.columns if c != text and c not in ("n_tokens", "ids", "decoded")]
    raw = docs.sparkSession.sparkContext.broadcast(model.raw)
    mark = hashlib.sha1(model.raw).hexdigest()

    def prepared() -> tuple[PieceModel, ChunkTable]:
        made = PieceModel(raw.value)
        return made, ChunkTable(PieceEncoder(made).resolve, split=made.split)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = worker_memory(("pieces", mark), prepared)
        begin, end = (np.array([i], "<u4").tobytes() for i in (own.begin, own.end))
        known = pa.array(own.texts, pa.large_binary())
        for batch in batches:
            n, ids, texts = [], [], []
            for block in blocks(batch.column(batch.num_columns - 1)):
                found, offsets = parts.encode_block(block)
                for a, b in zip(offsets, offsets[1:]):
                    n.append(b - a + 2)
                    ids.append(begin + found[a:b].astype("<u4", copy=False).tobytes() + end)
                # Begin and end ids stand for no text.
                for back in joined(found, offsets, known, b"").to_pylist():
                    texts.append(back.removeprefix(own.prefix).decode())
            made = [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*others, *[f.name for f in added]])

    rows = docs.select(*others, F.col(text))
    return rows.mapInArrow(encoded, StructType([*rows.schema.fields[:-1], *added]))


def load_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return PieceModel(file.read())


def op13_backtracking_pieces(spark, sf_dir):
    """Ids of every document and their decoded text, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = encode_documents(docs, load_model(public_tokenizers.path("piece_bpe_32k.model")))
    return rows.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op13_backtracking_pieces": op13_backtracking_pieces}
ORACLES: dict[str, str] = {}
