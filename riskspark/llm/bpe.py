"""BPE encoding with a minimal acyclic transducer of frequent words, and decoding.

Frequent words of the corpus, each with its ids, are compiled into a minimal acyclic automaton: equal
suffixes share states, and numbers on the transitions add up to the rank of the word, which
leads to its ids. The automaton lies in one file that workers map into memory. Other words are merged
exactly as the merge list says.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspark.llm.chunks import ChunkTable, blocks, joined, white_space_pieces
from riskspark.llm.common import small_batches, stored, table, worker_memory

#: Most frequent words that are compiled.
LEXICON = 131_072
#: Merged words a worker remembers before it starts anew.
MERGED = 100_000
#: Words of up to so many bytes are merged on a plain list, longer ones with a queue.
SHORT = 48
_NEVER = 1 << 60
#: Stands for a line feed among ids.
_FEED = (1 << 32) - 1
#: Longer words are not compiled but merged, so neither the driver nor the automaton meets them.
COMPILED = 64
#: Different pieces a task counts before it hands on what it has.
COUNTED = 300_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """What a tokenizer file of this kind says: words, merges, pattern and special tokens."""

    def __init__(self, text: str):
        self.source = text
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or spec["post_processor"] or spec["decoder"]:
            raise ValueError("expected a plain BPE tokenizer file without post-processor and decoder")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unexpected normalizers {kinds}")
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # The same pattern for texts of ASCII bytes.
        ascii_pattern = self.word.pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        self.ascii_word = re.compile(ascii_pattern.encode())
        #: The same, and a line feed, which is in no word.
        self.ascii_word_or_feed = re.compile(ascii_pattern.encode() + rb"|\n")
        self.word_or_feed = regex.compile(self.word.pattern + r"|\n")
        letters = b"abcdefghijklmnopqrstuvwxyz"
        #: Whether letters alone are always one word.
        self.letters_join = bool(self.ascii_word.fullmatch(letters + letters[::-1]))
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.letters = byte_letters()

    @cached_property
    def tokens(self) -> list[bytes]:
        """The text of each id."""
        named = {**self.ids, **self.special}
        out = [b""] * (max(named.values()) + 1)
        for token, i in named.items():
            out[i] = token.encode()
        return out

    @cached_property
    def token_array(self) -> pa.Array:
        return pa.array(self.tokens, pa.large_binary())

    def words(self, piece: str) -> Iterator[bytes]:
        """Words of a text without special tokens, as UTF-8."""
        # Letters are lowered one by one: the end of a word changes no letter.
        # No code point below U+0378 is unassigned.
        if max(piece, default="") >= "\u0378":
            if any(unicodedata.category(c) == "Cn" for c in piece):
                return self._young_words(piece)
        plain = unicodedata.normalize("NFC", piece)
        plain = plain.lower() if "Σ" not in plain else "".join(c.lower() for c in plain)
        return map(str.encode, self.word.findall(plain))

    def _young_words(self, piece: str) -> Iterator[bytes]:
        """Words of a text with code points that Python's Unicode tables do not know yet.

        Whether these are letters, and which lower case they have, depends on the age of tables,
        so the library's own normalizer and pre-tokenizer decide.
        """
        plain = self._library.normalizer.normalize_str(piece)
        for word, _ in self._library.pre_tokenizer.pre_tokenize_str(plain):
            yield bytes(map(self._bytes.__getitem__, word))

    def library_merge(self, word: bytes) -> list[int]:
        """Ids of a word by the model of the tokenizers library."""
        # Printable ASCII bytes stand for themselves, control characters do not.
        if not (word.isascii() and (text := word.decode()).isprintable()):
            text = "".join(map(self.letters.__getitem__, word))
        return [t.id for t in self._library_tokenize(text)]

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.source)

    @cached_property
    def _library_tokenize(self) -> Callable:
        # Asking the tokenizer for its model makes a new object each time.
        return self._library.model.tokenize

    @cached_property
    def _bytes(self) -> dict[str, int]:
        return {letter: b for b, letter in enumerate(self.letters)}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word by its merges: least rank first, leftmost of equals."""
        parts = [self.letters[b] for b in word]
        parts[-1] += self.end
        n = len(parts)
        if n <= SHORT:
            rank = self.ranks.get
            order = [rank(pair, _NEVER) for pair in zip(parts, parts[1:])]
            while order and (least := min(order)) < _NEVER:
                i = order.index(least)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del order[i]
                if i:
                    order[i - 1] = rank((parts[i - 1], parts[i]), _NEVER)
                if i < len(order):
                    order[i] = rank((parts[i], parts[i + 1]), _NEVER)
            return [self.ids[p] for p in parts]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            rank = self.ranks.get((parts[i], parts[j])) if i >= 0 and j >= 0 else None
            if rank is not None:
                heapq.heappush(queue, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [self.ids[p] for p in parts if p]


class Transducer:
    """A minimal acyclic automaton from words to id lists, as flat arrays of one file."""

    NAMES = ("keys", "targets", "skips", "final", "starts", "ids")
    TYPES = (np.int64, np.int32, np.int32, np.uint8, np.int64, np.uint32)

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Transducer:
        """Build from words and outputs, adding words in order and sharing each finished suffix."""
        ordered = sorted(w for w in words if w)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        counts: list[int] = []

        def finish(final: bool, moves: list[tuple[int, int]]) -> int:
            key = (final, tuple(moves))
            if key not in register:
                register[key] = len(states)
                states.append(key)
                counts.append(final + sum(counts[t] for _, t in moves))
            return register[key]

        # The open path of the last word: for each depth, whether a word ends there, and its finished moves.
        path: list[list] = [[False, []]]
        last = b""
        for word in [*ordered, b""]:
            same = len(os.path.commonprefix([last, word]))
            while len(path) > same + 1:
                final, moves = path.pop()
                path[-1][1].append((last[len(path) - 1], finish(final, moves)))
            for _ in word[same:]:
                path.append([False, []])
            if word:
                path[-1][0] = True
            last = word
        root = finish(*path[0])
        # The root gets number 0, so that a walk begins there.
        number = {root: 0} | {s: s + (s < root) for s in range(len(states)) if s != root}
        keys, targets, skips, final = [], [], [], np.zeros(len(states), np.uint8)
        for state, i in sorted(number.items(), key=lambda x: x[1]):
            ends, moves = states[state]
            final[i] = ends
            skip = int(ends)
            for label, target in moves:
                keys.append(i * 256 + label)
                targets.append(number[target])
                skips.append(skip)
                skip += counts[target]
        lengths = [len(words[w]) for w in ordered]
        values = (
            keys,
            targets,
            skips,
            final,
            np.concatenate(([0], np.cumsum(lengths))),
            [i for w in ordered for i in words[w]],
        )
        return cls({n: np.array(v, t) for n, t, v in zip(cls.NAMES, cls.TYPES, values)})

    def save(self, path: str) -> None:
        """Write one file: six lengths as 64-bit integers, then the arrays at multiples of 8 bytes."""
        arrays = [getattr(self, name) for name in self.NAMES]
        with open(path, "wb") as file:
            file.write(np.array([len(a) for a in arrays], "<i8").tobytes())
            for a in arrays:
                file.write(a.tobytes())
                file.write(b"\0" * (-a.nbytes % 8))

    @classmethod
    def load(cls, path: str) -> Transducer:
        """Map a saved file into memory."""
        raw = np.memmap(path, np.uint8, "r")
        at, arrays = 48, {}
        for name, kind, n in zip(cls.NAMES, cls.TYPES, raw[:48].view("<i8").tolist()):
            size = n * np.dtype(kind).itemsize
            arrays[name] = raw[at : at + size].view(kind)
            at += size + -size % 8
        return cls(arrays)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words that are not compiled; all words walk side by side."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        state, rank = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive = np.flatnonzero(lengths > 0) if len(self.keys) else np.zeros(0, np.int64)
        ended: list[np.ndarray] = []
        depth = 0
        while len(alive):
            wanted = state[alive] * 256 + letters[begins[alive] + depth]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[at] == wanted
            alive, at = alive[found], at[found]
            state[alive] = self.targets[at]
            rank[alive] += self.skips[at]
            depth += 1
            done = lengths[alive] == depth
            ended.append(alive[done])
            alive = alive[~done]
        out = np.full(n, -1, np.int64)
        if ended:
            whole = np.concatenate(ended)
            whole = whole[self.final[state[whole]] == 1]
            out[whole] = rank[whole]
        return out


class Encoder:
    """Ids of text pieces: compiled words from the transducer, all others by merging."""

    def __init__(
        self,
        vocabulary: Vocabulary,
        transducer: Transducer | None = None,
        merge: Callable[[bytes], list[int]] | None = None,
    ):
        self.vocabulary, self.transducer = vocabulary, transducer
        self.merge = merge or vocabulary.merge
        self.merged: dict[bytes, list[int]] = {}

    def split(self, piece: bytes) -> list[bytes | int]:
        """Words and ids of special tokens of one piece."""
        v = self.vocabulary
        if v.letters_join and piece.isalpha():
            return [piece.lower()]
        if piece.isascii() and b"<" not in piece:
            return v.ascii_word.findall(piece.lower())
        text = piece.decode("utf-8", "replace")
        if "<" not in text or not v.specials.search(text):
            return list(v.words(text))
        out: list[bytes | int] = []
        at = 0
        for hit in v.specials.finditer(text):
            out += v.words(text[at : hit.start()])
            out.append(v.special[hit.group()])
            at = hit.end()
        return out + list(v.words(text[at:]))

    def resolve_all(self, pieces: list[bytes]) -> pa.ListArray:
        """``resolve`` by merging alone, for pieces without ASCII white space: most are split together, one a line."""
        if len(self.merged) > MERGED:
            self.merged.clear()
        v, ids = self.vocabulary, self.merged
        kinds = np.fromiter((2 if b"<" in p else 0 if p.isascii() else 1 for p in pieces), np.uint8, len(pieces))
        lines = b"\n".join([*compress(pieces, kinds == 0), b""]).lower()
        words: list[bytes | int] = v.ascii_word_or_feed.findall(lines)
        text = b"\n".join([*compress(pieces, kinds == 1), b""]).decode("utf-8", "replace")
        if any(c >= "\u0378" and unicodedata.category(c) == "Cn" for c in set(text)):
            kinds[kinds == 1] = 2
        else:
            # No sigma is left whose lower case depends on the letters around it.
            plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            words += map(str.encode, v.word_or_feed.findall(plain))
        for piece in compress(pieces, kinds == 2):
            words += self.split(piece)
            words.append(b"\n")
        ids[b"\n"] = [_FEED]
        special = v.special.values()
        for word in set(words).difference(ids):
            ids[word] = [word] if word in special else self.merge(word)
        flat = np.fromiter(chain.from_iterable(map(ids.__getitem__, words)), np.uint32)
        feeds = np.flatnonzero(flat == _FEED)
        ends = np.concatenate(([0], feeds - np.arange(len(feeds))))
        found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[flat != _FEED]))
        # Back from the order of kinds.
        return found.take(pa.array(np.argsort(np.argsort(kinds, kind="stable"))))

    def resolve(self, pieces: list[bytes]) -> list[list[int]]:
        if len(self.merged) > MERGED:
            self.merged.clear()
        own = self.split
        if self.vocabulary.letters_join:
            split = [[p.lower()] if p.isalpha() else own(p) for p in pieces]
        else:
            split = [own(p) for p in pieces]
        words = list(set(chain.from_iterable(split)).difference(self.vocabulary.special.values()))
        ids: dict[bytes | int, list[int]] = {i: [i] for i in self.vocabulary.special.values()}
        t = self.transducer
        if t is not None:
            ranks = t.ranks(words)
            known = np.flatnonzero(ranks >= 0)
            begins, ends = t.starts[ranks[known]].tolist(), t.starts[ranks[known] + 1].tolist()
            compiled = t.ids.tolist() if len(known) > len(t.starts) // 8 else t.ids
            for i, a, b in zip(known.tolist(), begins, ends):
                ids[words[i]] = compiled[a:b]
            words = [words[i] for i in np.flatnonzero(ranks < 0)]
        merged, merge = self.merged, self.merge
        for word in words:
            found = merged.get(word)
            if found is None:
                found = merged[word] = merge(word)
            ids[word] = found
        return [
            ids[parts[0]] if len(parts) == 1 else [i for part in parts for i in ids[part]]
            for parts in split
        ]


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The text that ids stand for: their tokens, joined by blanks, as UTF-8."""
    return b" ".join(map(vocabulary.tokens.__getitem__, ids.tolist()))


def frequent_words(docs: DataFrame, text: str, vocabulary: Vocabulary, size: int) -> list[bytes]:
    """The most frequent words of all documents of up to ``COMPILED`` bytes, up to ``size`` of them.

    Pieces between white space are counted per task before the shuffle, and each distinct one is split into words after it. A histogram of counts on a logarithmic scale, which has
    some hundred rows at most, gives the least count to take; no task sends more than its share.
    """
    source = docs.sparkSession.sparkContext.broadcast(vocabulary.source)
    mark = hashlib.sha1(vocabulary.source.encode()).hexdigest()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def combined() -> pa.Table:
            found = pa.concat_tables(held).group_by("w").aggregate([("n", "sum")])
            return found.select(["w", "n_sum"]).rename_columns(["w", "n"])

        for batch in batches:
            for block in blocks(batch.column(0)):
                seen = pc.value_counts(white_space_pieces(block)[0].cast(pa.binary()))
                held.append(pa.table({"w": seen.field("values"), "n": seen.field("counts")}))
                if sum(map(len, held)) > 2 * COUNTED:
                    held = [combined()]
                    if len(held[0]) > COUNTED:
                        yield from held.pop().to_batches()
        if held:
            yield from combined().to_batches()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(worker_memory(("vocabulary", mark), lambda: Vocabulary(source.value)))
        for batch in batches:
            seen: Counter[bytes] = Counter()
            pieces, times = (c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns)
            for piece, n in zip(pieces, times):
                for w in encoder.split(piece):
                    if isinstance(w, bytes):
                        seen[w] += n
            arrays = [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["w", "n"])

    counts = docs.select(F.col(text)).mapInArrow(pieces, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    # Each distinct piece is split once.
    counts = counts.mapInArrow(words, "w binary, n long").where(F.length("w") <= COMPILED).groupBy("w")
    counts = counts.agg(F.sum("n").alias("n")).withColumn("step", F.floor(F.log2("n") * 16))
    counts = stored(counts, "word-counts")
    least, taken = None, 0
    for step, n in sorted(map(tuple, counts.groupBy("step").count().collect()), reverse=True):
        taken += n
        if taken > size:
            break
        least = step
    if least is None:
        return []
    return [bytes(r["w"]) for r in counts.where(F.col("step") >= least).select("w").collect()]


def compile_lexicon(docs: DataFrame, text: str, vocabulary: Vocabulary, size: int = LEXICON) -> str:
    """Compile the frequent words and hand the file to every executor; returns its name.

    The file is sent by Spark itself, also to executors that join later, and has a few megabytes.
    """
    words = frequent_words(docs, text, vocabulary, size)
    name = f"lexicon-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(), name)
    Transducer.compile({w: vocabulary.merge(w) for w in words}).save(path)
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", size: int = LEXICON, keep_ids: bool = False
) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    With ``keep_ids`` also ``ids`` (array<int>) and ``decoded``. Texts are whole; null and empty ones have no
    ids. Repeated rows and all other columns are kept as they are (those named as what is added
    are replaced); an empty table gives an empty one. A very long text is worked on as one value, its
    pieces at most once each.
    """
    small_batches(docs.sparkSession)
    added = ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    others = [c for c in docs.columns if c != text]
    name = compile_lexicon(docs, text, vocabulary, size)
    source = docs.sparkSession.sparkContext.broadcast(vocabulary.source)
    mark = hashlib.sha1(vocabulary.source.encode()).hexdigest()
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    if keep_ids:
        fields += StructType.fromDDL("ids array<int>, decoded string").fields

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = worker_memory(("vocabulary", mark), lambda: Vocabulary(source.value))
        lexicon = SparkFiles.get(name)
        pieces = worker_memory(
            ("transducer", name), lambda: ChunkTable(Encoder(v, Transducer.load(lexicon)).resolve)
        )
        for batch in batches:
            n, ids_sha, decoded_sha, kept, texts = [], [], [], [], []
            for block in blocks(batch.column(batch.num_columns - 1)):
                ids, offsets = pieces.encode_block(block)
                n += np.diff(offsets).tolist()
                for a, b in zip(offsets, offsets[1:]):
                    ids_sha.append(hashlib.sha256(ids[a:b].astype("<u4", copy=False)).hexdigest())
                    if keep_ids:
                        kept.append(ids[a:b].astype(np.int32))
                for back in joined(ids, offsets, v.token_array, b" ").to_pylist():
                    decoded_sha.append(hashlib.sha256(back).hexdigest())
                    if keep_ids:
                        texts.append(back.decode())
            made = [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            if keep_ids:
                made += [pa.array(kept, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *made], [*others, *[f.name for f in fields]]
            )

    rows = docs.select(*others, F.col(text))
    return rows.mapInArrow(encoded, StructType([*rows.schema.fields[:-1], *fields]))


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def op4_transducer_bpe(spark, sf_dir):
    """Ids of every document and their decoded text, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_documents(docs, load_vocabulary(public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {"op4_transducer_bpe": op4_transducer_bpe}
ORACLES: dict[str, str] = {}
