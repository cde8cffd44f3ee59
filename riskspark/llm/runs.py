"""Periodic runs of words by a suffix automaton with link-cut access.

Every state of the automaton of a word sequence stands for strings with the same ends. Appending word i makes i the last end of all
suffixes of the sequence up to it: the path from its state to the root. Before, that path falls into segments with one
last end each; a segment with last end e whose longest string has L words says that these L words end at e and at i. If
i - e <= L, the two overlap or touch: a square of period i - e. As the next longer suffix ended elsewhere, the square cannot be extended to the
left; as no shorter distance was found, i - e is its least period. The last i that gives the same start and period ends
the run. Segments are found and recoloured by link-cut access, as many as the logarithm of the length on average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskspark.llm.common import small_batches, table, utf8

#: Words of documents that are examined together.
BLOCK_WORDS = 500_000
#: Stretches of more words are cut into overlapping parts by period, so that an automaton stays small.
PART_WORDS = 50_000
RUN = "struct<start:bigint,length:bigint,period:bigint>"

#: Start, length and period of a run.
Run = tuple[int, int, int]


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lengths and suffix links of the states of a sequence, and the state of each of its prefixes."""
    length, link, moves = [0], [-1], [{}]
    prefixes = []
    last = 0
    for word in words:
        state = len(length)
        length.append(length[last] + 1)
        moves.append({})
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = state
            at = link[at]
        if at < 0:
            link.append(0)
        else:
            target = moves[at][word]
            if length[target] == length[at] + 1:
                link.append(target)
            else:
                clone = state + 1
                link.append(clone)
                length.append(length[at] + 1)
                moves.append(moves[target].copy())
                link.append(link[target])
                link[target] = clone
                while at >= 0 and moves[at].get(word) == target:
                    moves[at][word] = clone
                    at = link[at]
        prefixes.append(state)
        last = state
    return length, link, prefixes


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """The end of the run for each start and least period at which a square begins.

    The automaton is complete before its paths are recoloured. States made later only divide strings that had all ends in common
    at the time, so the segments are those of the growing automaton.
    """
    length, link, prefixes = suffix_automaton(words)
    size = len(length)
    # Splay trees hold the coloured segments, nearer to the root on the left; the colour is that of the splay tree's root.
    up, left, right, colour = link, [-1] * size, [-1] * size, [-1] * size
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefixes):
        below, x = -1, state
        while x >= 0:
            p = up[x]
            while p >= 0 and ((on_left := left[p] == x) or right[p] == x):
                g = up[p]
                inner = g >= 0 and (left[g] == p or right[g] == p)
                if inner and (left[g] == p) == on_left:
                    # Both on one side: turn the upper edge first.
                    gg = up[g]
                    if on_left:
                        c = left[g] = right[p]
                        right[p] = g
                    else:
                        c = right[g] = left[p]
                        left[p] = g
                    if c >= 0:
                        up[c] = g
                    up[g], up[p] = p, gg
                    if gg >= 0 and left[gg] == g:
                        left[gg] = p
                    elif gg >= 0 and right[gg] == g:
                        right[gg] = p
                    else:
                        colour[p] = colour[g]
                    g = gg
                    inner = g >= 0 and (left[g] == p or right[g] == p)
                if on_left:
                    c = left[p] = right[x]
                    right[x] = p
                else:
                    c = right[p] = left[x]
                    left[x] = p
                if c >= 0:
                    up[c] = p
                up[p], up[x] = x, g
                if not inner:
                    colour[x] = colour[p]
                elif left[g] == p:
                    left[g] = x
                else:
                    right[g] = x
                p = g
            before = colour[x]
            period = i - before
            if before >= 0 and period <= length[x]:
                found[before - length[x] + 1, period] = i
            if (c := right[x]) >= 0:
                colour[c] = before
            right[x] = below
            below, x = x, up[x]
        colour[below] = i
    return found


def distances(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each word the distance to the same word before it in its document, or a very large number.

    ``begins`` holds, for each word, where its document begins.
    """
    n = len(codes)
    far = np.full(n, np.iinfo(np.int64).max, np.int64)
    order = np.argsort(codes, kind="stable")
    here, there = order[1:], order[:-1]
    same = (codes[here] == codes[there]) & (there >= begins[here])
    far[here[same]] = here[same] - there[same]
    return far


def stretches(far: np.ndarray, shortest: int, exponent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each power of two, first and last places of the stretches that runs of a period up to it (and over half of it) can lie in.

    In a run of period q every word but the first q is at most q words after the same word. So a
    run of period q lies in a stretch of so small distances and the q words before it. A
    document's first word is far from any other, so no stretch goes across documents.
    """
    reach = 1
    while True:
        least = max((exponent - 1) * (reach // 2 + 1), shortest - reach, 1)
        if least > len(far):
            return
        near = np.concatenate(([0], (far <= reach).view(np.int8), [0]))
        steps = np.diff(near)
        first, last = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) - 1
        long = last - first + 1 >= least
        if long.any():
            yield reach, first[long], last[long]
        reach *= 2


def _long(found: dict[tuple[int, int], int], offset: int, shortest: int, exponent: int) -> Iterator[Run]:
    for (start, period), end in found.items():
        n = end - start + 1
        if n >= shortest and n >= exponent * period:
            yield start + offset, n, period


def _joined(parts: list[Run]) -> Iterator[Run]:
    """Runs from their overlapping parts: two parts of one period that share that many words belong together."""
    open_run = None
    for period, start, n in sorted((p, s, n) for s, n, p in parts):
        if open_run and open_run[2] == period and open_run[0] + open_run[1] - start >= period:
            open_run = (open_run[0], max(open_run[1], start + n - open_run[0]), period)
        else:
            if open_run:
                yield open_run
            open_run = (start, n, period)
    if open_run:
        yield open_run


def runs_of(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, shortest: int, exponent: int, part: int) -> set[Run]:
    """All runs of at least ``shortest`` words and ``exponent`` periods; ``begins`` and ``ends`` bound the document of each word.

    Only stretches that can hold such a run reach an automaton, each with one word more on both sides, so its runs are whole.
    """
    out: set[Run] = set()
    spans = []
    for reach, first, last in stretches(distances(codes, begins), shortest, exponent):
        low = np.maximum(first - reach - 1, begins[first])
        high = np.minimum(last + 2, ends[first])
        spans += [(int(a), int(b), reach) for a, b in zip(low, high)]
    spans.sort()
    at = 0
    while at < len(spans):
        low, high = spans[at][:2]
        until = at + 1
        while until < len(spans) and spans[until][0] < high and begins[spans[until][0]] == begins[low]:
            high = max(high, spans[until][1])
            until += 1
        if high - low <= part:
            out.update(_long(squares(codes[low:high].tolist()), low, shortest, exponent))
        else:
            for a, b, reach in spans[at:until]:
                # Parts share two periods, so each holds enough of a run to see its period.
                size, common = max(part, 8 * reach), 2 * reach
                parts: list[Run] = []
                for c in range(a, max(b - common, a + 1), size - common):
                    found = squares(codes[c : min(c + size, b)].tolist())
                    parts += [r for r in _long(found, c, 1, 2) if reach < 2 * r[2] <= 2 * reach]
                out.update(r for r in _joined(parts) if r[1] >= shortest and r[1] >= exponent * r[2])
        at = until
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words without those that a run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, n, period in runs:
        keep[start + period : start + n] = False
    return [words[i] for i in np.flatnonzero(keep)]


def periodic_runs(
    docs: DataFrame, text: str = "text", shortest: int = 6, exponent: int = 4, part: int = PART_WORDS
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are parted by ASCII white space and numbered from 0. ``runs`` holds ``start``, ``length`` and least ``period`` of each
    longest stretch that repeats with its period, has at least ``shortest`` words and ``exponent`` (2 or more) periods, by start
    and period; ``collapsed`` joins with blanks the words that no run holds after its first period. Null and empty texts have no
    words, no runs and an empty ``collapsed``. All rows and other columns are kept, repeated rows too; columns named as what is
    added are replaced; an empty table gives an empty one. A text is worked on as one value; an automaton has at most
    ``part`` words or eight periods, whichever is more.
    """
    if exponent < 2 or shortest < 1:
        raise ValueError("a run has two periods and one word at least")
    small_batches(docs.sparkSession)
    added = StructType.fromDDL(f"n_words bigint, runs array<{RUN}>, collapsed string").fields
    names = [f.name for f in added]
    others = [c for c in docs.columns if c not in names]
    rows = docs.select(*[c for c in others if c != text], text)

    columns = rows.columns

    def block(split: list[list[bytes]]) -> list[pa.Array]:
        sizes = np.array([len(words) for words in split], np.int64)
        stops = np.cumsum(sizes)
        flat = pa.array([w for words in split for w in words], pa.binary())
        codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        found = runs_of(
            codes, np.repeat(stops - sizes, sizes), np.repeat(stops, sizes), shortest, exponent, part
        )
        lists: list[list[Run]] = [[] for _ in split]
        for start, n, period in sorted(found, key=lambda r: (r[0], r[2])):
            doc = int(np.searchsorted(stops, start, "right"))
            lists[doc].append((start - int(stops[doc] - sizes[doc]), n, period))
        kept = [collapsed(w, r) if r else w for w, r in zip(split, lists)]
        entries = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in lists]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        texts = [b" ".join(words).decode("utf-8", "replace") for words in kept]
        return [pa.array(sizes), pa.array(entries, kind), pa.array(texts, pa.string())]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, split, words = 0, [], 0
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                split.append(utf8(value.as_py()).split())
                words += len(split[-1])
                if words >= BLOCK_WORDS or i + 1 == batch.num_rows:
                    whole = batch.slice(at, len(split))
                    yield pa.RecordBatch.from_arrays([*whole.columns, *block(split)], [*columns, *names])
                    at, split, words = i + 1, [], 0

    return rows.mapInArrow(found, StructType([*rows.schema.fields, *added])).select(*others, *names)


def looped_text(id: str, text: str) -> Column:
    """Every tenth text by a hash of its id with a periodic rest, as the contract of the query sets out; a null id changes nothing."""
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def looped(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: words[i]), " ")).otherwise("")

    words = F.regexp_extract_all(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    # A list of one binds the words, so they are cut once.
    return F.when(h % 10 == 0, F.transform(F.array(words), looped)[0]).otherwise(F.col(text))


def greatest_run(runs: Column) -> Column:
    """The run with the greatest length by period, the first of equals."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def op11_automaton_runs(spark, sf_dir):
    """Runs of six words and four periods or more of every document, every tenth with a planted one."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = periodic_runs(docs.select("doc_id", looped_text("doc_id", "text").alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return rows.withColumn("best", greatest_run(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda t: F.concat(t, F.lit("\n"))), "").cast("binary"), 256).alias(
            "runs_sha256"
        ),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_automaton_runs": op11_automaton_runs}
ORACLES: dict[str, str] = {}
