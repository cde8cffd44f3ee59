"""Removal of long repeated byte strings by a sparse enhanced suffix array.

Every window of ``LENGTH`` bytes is assigned to the least of its hashed ``ANCHOR``-byte strings; equal windows choose the
same string at the same offset. Consecutive windows with one anchor form a run, so suffixes are
sorted at anchors only, about one in 80 bytes. Runs that are equal as a whole are counted.
Where an anchor has different runs, their texts to the right of it form a suffix array with a common-prefix
interval tree; a stack scan visits its intervals, and the texts to the left tell
which members of an interval extend to the same string of full length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import small_batches, stored, table, utf8, worker_memory

LENGTH = 200
ANCHOR = 48
#: Bytes of a text worked on at once; runs are cut there, which changes no result.
BLOCK = 1 << 19
#: Anchors with more different runs are compared window by window, spread over all tasks.
FULL_GROUP = 4_096

_RANDOM = np.random.default_rng(20240917)
_LETTERS = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of any stretch of a text from one running sum, by a polynomial modulo 2**64."""

    def __init__(self, text: np.ndarray):
        size = max(1 << 12, 1 << (len(text) + 1).bit_length())
        up, self.down = worker_memory(
            (f"powers {size}", 0), lambda: (_powers(_BASE, size), _powers(_INVERSE, size))
        )
        sums = np.cumsum(_LETTERS[text] * up[: len(text)], dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), sums))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def rolling(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value, the first of equals, in each window of ``width``."""
    n = len(values)
    index = np.uint64((1 << 20) - 1)
    keyed = (values & ~index) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = keyed
    rows = padded.reshape(-1, width)
    heads = np.minimum.accumulate(rows, axis=1).ravel()
    tails = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tails[: n - width + 1], heads[width - 1 : n])
    return (least & index).astype(np.int64)


def runs_of(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of a text: anchor hash, run hash, first window, number of windows, anchor's place in the run."""
    parts = []
    for begin in range(0, len(text) - length + 1, BLOCK):
        block = np.frombuffer(text, np.uint8, min(BLOCK + length - 1, len(text) - begin), begin)
        hasher = Hasher(block)
        anchors = hasher.rolling(ANCHOR)
        at = sliding_argmin(anchors, length - ANCHOR + 1)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:], [len(at)])) - 1
        place = at[first] - first
        run = hasher.of(first, last + length) ^ mixed(place.astype(np.uint64) + np.uint64(1))
        parts.append((anchors[at[first]], run, first + begin, last - first + 1, place))
    if not parts:
        parts = [(np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3]
    a, r, f, n, p = (np.concatenate(x) for x in zip(*parts))
    return a.view(np.int64), r.view(np.int64), f, n, p


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """All intervals ``(depth, first, last)`` of a suffix array, children before parents, by one stack scan.

    ``lcp[i]`` is the common prefix of suffixes ``i`` and ``i + 1``.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def cover(lefts: list[bytes], rights: list[bytes], length: int) -> list[tuple[int, int] | None]:
    """How far each member of an anchor's group lies in strings of ``length`` that other members have too.

    ``rights`` are the sorted texts from the anchor on, ``lefts`` the reversed texts before it. Members of a
    common-prefix interval of depth ``d`` repeat if their lefts agree on the missing ``length - d``
    bytes; an interval whose lefts differ there branches into several repeats or none. All
    repeats of a member hold its anchor, so their union is one stretch: (bytes before, bytes after).
    """
    n = len(rights)
    lcp = [common(rights[i], rights[i + 1]) for i in range(n - 1)]
    reach = [[0, 0] for _ in range(n)]
    for depth, first, last in intervals(lcp):
        missing = max(length - depth, 0)
        members = [m for m in range(first, last + 1) if len(lefts[m]) >= missing]
        members.sort(key=lefts.__getitem__)
        shared = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for k, m in enumerate(members):
            best = max(shared[k - 1] if k else -1, shared[k] if k < len(shared) else -1)
            if best >= missing:
                reach[m][0] = max(reach[m][0], best)
                reach[m][1] = max(reach[m][1], depth)
    return [tuple(r) if r[1] else None for r in reach]


def _keys(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


_RUNS = "k1 long, k2 long, anchor long, run long, first long, n long, place long"


def _emit_runs(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs_of(utf8(t.as_py()), length) for t in batch.column(2)]
            sizes = [len(f[0]) for f in found]
            keys = [np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1)]
            rest = [np.concatenate(x) for x in zip(*found)] if found else []
            if rest:
                names = [f.split()[0] for f in _RUNS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in keys + rest], names)

    return emit


_CONTEXTS = "anchor long, run long, c long, full boolean, place long, lefts binary, rights binary"


def _emit_contexts(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            fields = {
                f.name: wanted.flatten().field(f.name) for f in wanted.type.value_type
            }
            ends = np.cumsum([len(w) for w in wanted])
            first, n, place = (fields[f].to_numpy() for f in ("first", "n", "place"))
            lefts, rights, at = [], [], 0
            for t, end in zip(batch.column(0), ends.tolist()):
                text = utf8(t.as_py())
                for i in range(at, end):
                    a, m = int(first[i]), int(first[i] + place[i])
                    lefts.append(text[a:m][::-1])
                    rights.append(text[m : min(m + length, a + int(n[i]) - 1 + length)])
                at = end
            yield pa.RecordBatch.from_arrays(
                [
                    *[fields[f] for f in ("anchor", "run", "c", "full", "place")],
                    pa.array(lefts, pa.binary()),
                    pa.array(rights, pa.binary()),
                ],
                [f.split()[0] for f in _CONTEXTS.split(", ")],
            )

    return emit


_COVERS = "anchor long, run long, before long, after long"


def _emit_covers(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def close() -> None:
            for (anchor, run, c, _, _), reach in zip(
                held, cover([h[3] for h in held], [h[4] for h in held], length)
            ):
                if c == 1 and reach:
                    out.append((anchor, run, *reach))
            held.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            names = [f.split()[0] for f in _COVERS.split(", ")]
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            out.clear()
            return made

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    close()
                held.append(row)
            yield flush()
        close()
        yield flush()

    return emit


def _emit_windows(length: int):
    """Each window of a run, by the anchor's offset in it and two hashes of its bytes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, run, c, left, right in zip(*(x.to_pylist() for x in batch.columns)):
                text = np.frombuffer(left[::-1] + right, np.uint8)
                hashes = Hasher(text).rolling(length).view(np.int64)
                n = len(hashes)
                offsets = len(left) - np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, anchor)),
                        pa.array(np.full(n, run)),
                        pa.array(np.full(n, c)),
                        pa.array(offsets),
                        pa.array(hashes),
                    ],
                    ["anchor", "run", "c", "offset", "window"],
                )

    return emit


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans ``lo``, ``hi`` of every text (``k1``, ``k2``) covered by strings that start elsewhere too.

    ``texts`` has the columns ``k1``, ``k2`` and ``text`` (not null), a row for each document. Equal texts
    have equal keys and one set of spans. Spans may overlap.
    """
    small_batches(texts.sparkSession)
    runs = stored(texts.select("k1", "k2", "text").mapInArrow(_emit_runs(length), _RUNS), "runs")
    again = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    # Written, so that the join reads two plain exchanges, whose large partitions Spark can split.
    again = stored(again.select("anchor"), "shared-anchors")
    shared = stored(runs.join(again, "anchor"), "shared-runs")
    # One row for each different run; what occurs twice as a whole is covered as a whole.
    distinct = stored(
        shared.groupBy("anchor", "run").agg(
            F.count(F.lit(1)).alias("c"), F.min(F.struct("k1", "k2", "first", "n", "place")).alias("at")
        ),
        "distinct-runs",
    )
    sizes = distinct.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("__runs"), F.min("c").alias("__least")
    )
    sizes = sizes.where("__runs > 1 and __least = 1")
    wanted = distinct.join(sizes, "anchor").select(
        F.col("at.k1").alias("k1"),
        F.col("at.k2").alias("k2"),
        F.struct(
            "anchor", "run", "c", (F.col("__runs") > FULL_GROUP).alias("full"), "at.first", "at.n", "at.place"
        ).alias("wanted"),
    )
    # At most one for each run of the text, so as long as the text at most.
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_list("wanted").alias("wanted"))
    contexts = (
        texts.join(wanted, ["k1", "k2"])
        .select("text", "wanted")
        .mapInArrow(_emit_contexts(length), _CONTEXTS)
        .distinct()
    )
    contexts = stored(contexts, "run-contexts")
    small = (
        contexts.where(~F.col("full"))
        .select("anchor", "run", "c", "lefts", "rights")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "rights")
        .mapInArrow(_emit_covers(length), _COVERS)
    )
    windows = (
        contexts.where("full")
        .select("anchor", "run", "c", "lefts", "rights")
        .mapInArrow(
            _emit_windows(length), "anchor long, run long, c long, offset long, window long"
        )
    )
    twice = windows.groupBy("anchor", "offset", "window").agg(F.count(F.lit(1)).alias("__n"))
    large = (
        windows.where("c = 1")
        .join(twice.where("__n > 1"), ["anchor", "offset", "window"])
        .groupBy("anchor", "run")
        .agg(F.max("offset").alias("before"), (length - F.min("offset")).alias("after"))
    )
    whole = distinct.where("c > 1").select(
        "anchor",
        "run",
        F.col("at.place").alias("before"),
        (F.col("at.n") - 1 - F.col("at.place") + length).alias("after"),
    )
    covers = stored(small.unionByName(large).unionByName(whole), "run-covers")
    anchor_at = F.col("first") + F.col("place")
    return shared.join(covers, ["anchor", "run"]).select(
        "k1",
        "k2",
        (anchor_at - F.col("before")).alias("lo"),
        (anchor_at + F.col("after")).alias("hi"),
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal stretches of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def strip_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else is taken out, the first
    occurrence too; strings are judged on the input. With ``keep_text`` the remaining text is returned as ``text``; bytes that
    are no longer valid UTF-8 at a cut are left out of it (digests are of all remaining bytes).

    Null counts as empty; texts shorter than ``length`` stay whole; equal texts of at least that
    length are removed whole; repeated rows and other columns are kept, whatever their names (columns named as those added are
    replaced); an empty table gives an empty one. A very long text is worked on in blocks.
    """
    added = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in added])
    names = [c for c in docs.columns if c != text]
    # Names of this function's own, so that no given one clashes with those it adds.
    docs = docs.toDF(*["body" if c == text else f"c{names.index(c)}" for c in docs.columns])
    others = [f"c{i}" for i in range(len(names))]
    body = F.coalesce(F.col("body"), F.lit(""))
    texts = docs.select(*_keys(body), body.alias("text"))
    spans = repeated_spans(texts, length)
    # Overlapping spans of a text: as many as it has runs at most.
    spans = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))
    rows = docs.select(*others, body.alias("__text"), *_keys(body)).join(spans, ["k1", "k2"], "left")
    rows = rows.select(*others, "__text", "__spans")
    made = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    made += ", text string" if keep_text else ""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result: list[list] = [[] for _ in range(5)]
            for value, found in zip(batch.column(len(others)), batch.column(len(others) + 1)):
                raw = utf8(value.as_py())
                cuts = merged([(s["lo"], s["hi"]) for s in found.as_py() or ()])
                at, kept = 0, []
                for lo, hi in cuts:
                    kept.append(raw[at:lo])
                    at = hi
                left = b"".join([*kept, raw[at:]])
                digest = hashlib.sha256(left).hexdigest()
                row = (len(raw), len(raw) - len(left), len(cuts), digest, None)
                for column, x in zip(result, row):
                    column.append(x)
                if keep_text:
                    result[4][-1] = left.decode("utf-8", "ignore")
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(result, kinds)][: 4 + keep_text]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(others)], *columns],
                [*others, "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"][: len(others) + 4 + keep_text],
            )

    schema = docs.select(*others).schema
    for field in made.split(", "):
        schema = schema.add(*field.split())
    return rows.mapInArrow(strip, schema).toDF(*names, *schema.names[len(names) :])


def op3_suffix_intervals(spark, sf_dir):
    """What is left of every document without repeated strings of 200 bytes."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return strip_repeats(docs)


QUERIES = {"op3_suffix_intervals": op3_suffix_intervals}
ORACLES: dict[str, str] = {}
