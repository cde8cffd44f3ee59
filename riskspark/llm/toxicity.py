"""Toxicity behind disguise: a noisy-channel decoder restores words, a lexicon model scores them.

Leetspeak, symbols between letters, spaced-out letters and repeated letters span a lattice of characters.
Viterbi search under a character trigram model of the corpus finds the likeliest reading of each
suspicious word; plain words are read as they are.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskspark.llm import logistic
from riskspark.llm.common import id_remainder, labelled_texts, small_batches, stored, table, worker_memory

# Letters that a written character can stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Log costs of the channel: a substituted letter, a dropped separator, a dropped repeat, a dropped digit.
SUBSTITUTED, SEPARATOR, REPEAT, DIGIT = -1.0, -0.3, -0.2, -6.0
#: Letters the language model knows; rarer ones share one symbol.
ALPHABET = 64
#: Texts whose words are counted together.
TOGETHER = 64
#: Labelled documents of each class used at most, half for the lexicon and half for calibration.
SAMPLE = 4_000
#: Texts are scored in windows of twice so many words, each beginning in the middle of the one before.
HALF_WINDOW = 64
#: Words keep their own weight and that of their prefixes of these lengths.
PREFIXES = (4, 5, 6, 7)
#: A feature enters the lexicon with so many toxic documents and so high a log-odds ratio.
SUPPORT = 4
LEAST_ODDS = 1.5
LEXICON = 20_000
#: Distinct words a worker remembers before it forgets those not met lately, and words a task counts before it hands on.
MEMORY = 1_000_000
COUNTED = 300_000
#: Imaginary parts of remembered values: a piece that can be part of a spaced word, and one that holds several of its letters.
SINGLE, SEVERAL = 1, 2
#: Punctuation at the edges of a word that stands for no letter.
PUNCTUATION = ".,;:?\"'-)[]{}*/&%#=<>~^`_"

_SPACED = re.compile(r"(?<!\S)[^\W_](?:[ .\-_*][^\W_]){2,}(?!\w)|(?<!\S)\S(?: \S){3,}(?!\S)")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_RUN = re.compile(r"(.)\1\1")
_CHUNK = re.compile(r"\S+")
_DOUBLE = re.compile(r"(.)\1+")


class LanguageModel:
    """Character trigrams with word ends, smoothed by lower orders."""

    def __init__(self, trigrams: dict[str, int]):
        letters: Counter[str] = Counter()
        for gram, n in trigrams.items():
            letters[gram[2]] += n
        self.known = {c for c, _ in letters.most_common(ALPHABET)} | {"^", "$"}
        self.three: Counter[str] = Counter()
        for gram, n in trigrams.items():
            self.three["".join(map(self.fold, gram))] += n
        self.two: Counter[str] = Counter()
        self.one: Counter[str] = Counter()
        self.after_two: Counter[str] = Counter()
        self.after_one: Counter[str] = Counter()
        for gram, n in self.three.items():
            self.two[gram[1:]] += n
            self.one[gram[2]] += n
            self.after_two[gram[:2]] += n
            self.after_one[gram[1]] += n
        self.total = sum(self.one.values())
        self.cache: dict[str, float] = {}

    def fold(self, letter: str) -> str:
        return letter if letter in self.known else "?"

    def log(self, a: str, b: str, c: str) -> float:
        a, b, c = self.fold(a), self.fold(b), self.fold(c)
        gram = a + b + c
        value = self.cache.get(gram)
        if value is None:
            p1 = (self.one[c] + 0.1) / (self.total + 0.1 * (ALPHABET + 3))
            p2 = (self.two[b + c] + 2 * p1) / (self.after_one[b] + 2)
            p3 = (self.three[gram] + 2 * p2) / (self.after_two[a + b] + 2)
            value = self.cache[gram] = math.log(p3)
        return value


def decode(written: str, model: LanguageModel, whole: bool = False) -> str:
    """The likeliest word behind a written one: Viterbi over the lattice of readings.

    A state is the last two letters read; the work grows linearly with the length. With ``whole`` only
    characters that stand for no letter are dropped.
    """
    states: dict[tuple[str, str], tuple[float, tuple | None]] = {("^", "^"): (0.0, None)}
    previous = ""
    for char in written:
        readings = [(char, 0.0)] if char.isalpha() else []
        readings += [(c, SUBSTITUTED) for c in LEET.get(char, "")]
        drop = None
        if char == previous:
            drop = REPEAT
        elif not char.isalnum():
            drop = SEPARATOR
        elif char.isdigit() or not readings:
            drop = DIGIT
        if whole and readings:
            drop = None
        new: dict[tuple[str, str], tuple[float, tuple | None]] = {}
        for (a, b), (weight, path) in states.items():
            if drop is not None and (a, b) not in new or drop is not None and new[a, b][0] < weight + drop:
                new[a, b] = (weight + drop, path)
            for letter, cost in readings:
                value = weight + cost + model.log(a, b, letter)
                if (b, letter) not in new or new[b, letter][0] < value:
                    new[b, letter] = (value, (path, letter))
        states, previous = new, char
    _, path = max(((w + model.log(a, b, "$"), p) for (a, b), (w, p) in states.items()), key=lambda x: x[0])
    letters: list[str] = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def plain(chunk: str) -> str:
    """A blank-separated piece of text in lower case, with compatibility forms and hidden characters resolved."""
    if not chunk.isascii():
        chunk = unicodedata.normalize("NFKC", chunk)
        chunk = "".join(c for c in chunk if unicodedata.category(c) != "Cf")
    return chunk.lower()


def restore(chunk: str, model: LanguageModel) -> list[str]:
    """Readings of a piece of text: itself if it is a plain word, else also the decoded word."""
    chunk = plain(chunk)
    core = _EDGES.sub("", chunk)
    found = []
    if core != chunk and any(c in LEET for c in chunk if not c.isalnum()):
        # A symbol at an edge may be punctuation or a letter, and a doubled one two letters.
        found = [decode(chunk, model), decode(chunk, model, whole=True)]
    if core.isalpha():
        return [core, *found] if not _RUN.search(core) else [core, decode(core, model), *found]
    if not any(c.isalpha() for c in chunk):
        return found
    # Joined plain words are also read one by one.
    return [decode(core, model), *found] + [w for w in re.split(r"[\W\d_]+", core) if len(w) > 1]


def readings(chunk: str, model: LanguageModel) -> list[str]:
    """As :func:`restore`; a number is also read as the word its digits can stand for."""
    found = restore(chunk, model)
    if not found and any(c in LEET for c in plain(chunk)):
        found = [decode(plain(chunk), model, whole=True)]
    return found


def spaced_runs(text: str) -> Iterator[tuple[re.Match, str]]:
    """Runs of single characters, and joined."""
    return ((m, re.sub(r"[ .\-_*]", "", m.group())) for m in _SPACED.finditer(text))


def spaced(text: str) -> list[str]:
    """Runs of single characters, joined."""
    return [s for _, s in spaced_runs(text)]


def features(word: str) -> Iterator[str]:
    yield "=" + word
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n]


class ToxicityModel:
    """Weights of word features, and how their sums become a score."""

    def __init__(self, trigrams: dict[str, int]):
        self.trigrams = trigrams
        self.mark = uuid.uuid4().hex
        self.lexicon: dict[str, float] = {}
        self.weights, self.intercept = np.zeros(4), 0.0

    def fit(self, drawn: DataFrame, odds: float) -> None:
        """Learn the lexicon from one half of the drawn documents and calibrate on the other, whatever their length.

        ``odds`` is the ratio of toxic to clean among all labelled rows; the samples are balanced. Texts are read
        where they lie: to the driver come the lexicon and four numbers of each document's heaviest window.
        """
        shared = drawn.sparkSession.sparkContext.broadcast(self.trigrams)

        def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader = TextReader(shared.value, {})
            for batch in batches:
                for y, text in zip(batch["__y"], batch["__text"]):
                    found = list({f for w in reader.words(text) for f in features(w)})
                    yield pd.DataFrame({"f": pd.Series(found, dtype=object), "y": np.full(len(found), y, np.int32)})

        half = drawn.where("__half = 0")
        sizes = {r[0]: r[1] for r in half.groupBy("__y").count().collect()}
        n0, n1 = sizes.get(0, 0) + 1, sizes.get(1, 0) + 1
        counts = (
            half.select("__y", "__text")
            .mapInPandas(seen, "f string, y int")
            .groupBy("f")
            .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
            .where(F.col("a") >= SUPPORT)
        )
        weight = F.log((F.col("a") + 0.5) / n1) - F.log((F.col("b") + 0.5) / n0)
        best = counts.select("f", weight.alias("w")).where(F.col("w") >= LEAST_ODDS)
        self.lexicon = {r[0]: r[1] for r in best.orderBy(F.desc("w"), "f").limit(LEXICON).collect()}
        reader_of = self.reader(drawn.sparkSession)

        @F.pandas_udf("array<double>")
        def heaviest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            reader = reader_of()
            for texts in batches:
                yield pd.Series([max(reader.measure(t).tolist()) for t in texts], dtype=object)

        rows = drawn.where("__half = 1").select(F.col("__id").cast("string"), "__y", heaviest("__text")).collect()
        rows.sort(key=lambda r: (r[1], r[0]))
        x = np.array([r[2] for r in rows], float).reshape(-1, 4)
        y = np.array([r[1] for r in rows], float)
        self.weights, self.intercept = logistic.fit(x, y)
        if 0 < y.sum() < len(y):
            self.intercept += math.log(odds) - math.log(y.sum() / (len(y) - y.sum()))

    def reader(self, spark: SparkSession) -> Callable[[], TextReader]:
        """Makes, in a task, the reader of this model, or takes the one that its worker has."""
        shared, mark = spark.sparkContext.broadcast((self.trigrams, self.lexicon)), self.mark
        return lambda: worker_memory(("toxicity", mark), lambda: TextReader(*shared.value))

    def score(self, spark: SparkSession, text: Column) -> Column:
        """Probability that a text is toxic: that of its most toxic window; null counts as empty."""
        reader_of = self.reader(spark)
        weights, intercept = self.weights, self.intercept

        @F.pandas_udf(DoubleType())
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            reader = reader_of()
            for texts in batches:
                best = [logistic.score(reader.measure(t), weights, intercept).max() for t in texts]
                yield pd.Series(best, dtype=float)

        return of(text)


class TextReader:
    """Reads texts word by word and remembers what a written word stands for."""

    def __init__(self, trigrams: dict[str, int], lexicon: dict[str, float]):
        self.model = LanguageModel(trigrams)
        self.whole = {f[1:]: w for f, w in lexicon.items() if f[0] == "="}
        self.starts = {f: w for f, w in lexicon.items() if f[0] != "="}
        # Repeated letters may also be doubled ones.
        self.single = {_DOUBLE.sub(r"\1", f): w for f, w in self.whole.items() if len(f) > 3}
        self.known: dict[str, complex] = {}
        self.older: dict[str, complex] = {}

    def words(self, text: str | None) -> list[str]:
        """All restored words of a text."""
        text = text or ""
        found = [w for chunk in text.split() for w in readings(chunk, self.model)]
        return found + [decode(plain(s), self.model) for s in spaced(text)]

    def weight(self, word: str) -> float:
        best = self.whole.get(word, 0.0)
        starts, size = self.starts, len(word)
        for n in PREFIXES:
            if size > n and (w := starts.get(word[:n])) is not None and w > best:
                best = w
        if not best and _DOUBLE.search(word):
            best = self.single.get(_DOUBLE.sub(r"\1", word), 0.0)
        return best

    def value(self, chunk: str) -> complex:
        """The greatest weight of a piece's readings, and as imaginary part a mark if it can belong to a spaced word."""
        core = chunk.lower().strip(PUNCTUATION)
        if core.isascii() and core.isalpha() and chunk.isascii() and not _RUN.search(core):
            # A plain word: its only reading is itself.
            best = self.weight(core)
        else:
            best = max(map(self.weight, readings(chunk, self.model)), default=0.0)
        if len(chunk) == 1:
            return complex(best, SINGLE)
        second = chunk[1]
        if second.isalnum():
            return complex(best)
        if len(chunk) > 2 and second in ".-_*" and chunk[2].isalnum():
            return complex(best, SEVERAL)
        return complex(best, SINGLE)

    def values(self, chunks: list[str]) -> np.ndarray:
        known, older = self.known, self.older
        for chunk in set(chunks).difference(known):
            found = older.get(chunk)
            known[chunk] = self.value(chunk) if found is None else found
        out = np.fromiter(map(known.__getitem__, chunks), complex, len(chunks))
        if len(known) > MEMORY:
            self.known, self.older = {}, known
        return out

    def measure(self, text: str | None) -> np.ndarray:
        """Sum, largest, mean and number of the weights of the words of each window of a text, a row each."""
        text = text or ""
        chunks = text.split()
        found = self.values(chunks)
        values, marks = found.real, found.imag
        n = max(1, -(-len(chunks) // HALF_WINDOW))
        total, most, hits = np.zeros(n), np.zeros(n), np.zeros(n)
        words = np.full(n, HALF_WINDOW)
        words[-1] = len(chunks) - HALF_WINDOW * (n - 1)

        def add(at: np.ndarray, weights: np.ndarray) -> None:
            np.add.at(total, at, weights)
            np.maximum.at(most, at, weights)
            np.add.at(hits, at, weights >= 3)

        heavy = np.flatnonzero(values)
        add(heavy // HALF_WINDOW, values[heavy])
        # A spaced word has three letters at least: pieces of one letter in a row, or a piece of several.
        single = marks == SINGLE
        if (marks == SEVERAL).any() or (single[:-2] & single[1:-1] & single[2:]).any():
            joined = [(m.start(), w) for m, s in spaced_runs(text) if (w := self.weight(decode(plain(s), self.model)))]
            if joined:
                starts = np.fromiter((m.start() for m in _CHUNK.finditer(text)), np.int64, len(chunks))
                at = np.searchsorted(starts, [place for place, _ in joined], side="right") - 1
                add(at // HALF_WINDOW, np.array([w for _, w in joined]))
        if n > 1:
            total, hits, words = (x[:-1] + x[1:] for x in (total, hits, words))
            most = np.maximum(most[:-1], most[1:])
        return np.stack([np.log1p(total), most, total / (words + 20), np.log1p(hits)], axis=1)


def trigrams_of(words: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """Character trigrams of counted words between two begin marks and an end mark, in time linear in their letters."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # The marks are no letters, so no word holds them.
    text = "".join(f"^^{w}$" for w in words.to_numpy(zero_copy_only=False))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    sizes = lengths + 3
    ends = np.cumsum(sizes)
    inner = np.ones(len(points), bool)
    inner[ends - 1] = inner[ends - 2] = False
    at = np.flatnonzero(inner)
    grams, place = np.unique(points[at] << 42 | points[at + 1] << 21 | points[at + 2], return_inverse=True)
    n = np.bincount(place, np.repeat(counts, sizes - 2), len(grams)).astype(np.int64)
    letters = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], axis=1).astype("<u4")
    flat = letters.tobytes().decode("utf-32-le", "surrogatepass")
    names = pa.array([flat[i : i + 3] for i in range(0, len(flat), 3)], pa.string())
    return pa.RecordBatch.from_arrays([names, pa.array(n)], ["g", "n"])


def corpus_trigrams(docs: DataFrame, text: str) -> dict[str, int]:
    """Character trigram counts over the plain words of all documents.

    Tasks count words first and then the trigrams of each distinct one, however long it is. Letters are
    folded to the most frequent ones before anything reaches the driver, so the alphabet bounds what does.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> pa.RecordBatch:
            found = pa.concat_tables(held).group_by("w").aggregate([("n", "sum")]).combine_chunks()
            held.clear()
            if not len(found):
                return pa.RecordBatch.from_pydict({"g": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
            return trigrams_of(found["w"].chunk(0), found["n_sum"].to_numpy())

        for batch in batches:
            texts = pc.fill_null(batch.column(0), "")
            for at in range(0, len(texts), TOGETHER):
                pieces = pc.utf8_split_whitespace(pc.utf8_lower(texts.slice(at, TOGETHER))).flatten()
                seen = pc.value_counts(pieces.filter(pc.utf8_is_alpha(pieces)))
                held.append(pa.table({"w": seen.field("values"), "n": seen.field("counts")}))
            if sum(map(len, held)) > COUNTED:
                yield flush()
        if held:
            yield flush()

    grams = docs.select(F.col(text)).mapInArrow(counted, "g string, n long").groupBy("g").agg(F.sum("n").alias("n"))
    grams = stored(grams, "corpus-trigrams")
    # Every letter of a word is the last one of a trigram once.
    last = F.substring("g", 3, 1)
    letters = grams.where(last != "$").groupBy(last.alias("c")).agg(F.sum("n").alias("n"))
    common = [r[0] for r in letters.orderBy(F.desc("n"), "c").limit(ALPHABET).collect()] + ["^", "$"]
    folded = [F.substring("g", i, 1) for i in (1, 2, 3)]
    folded = F.concat(*[F.when(c.isin(common), c).otherwise("?") for c in folded])
    # At most (ALPHABET + 3) ** 3 rows.
    rows = grams.groupBy(folded.alias("g")).agg(F.sum("n").alias("n"))
    return {r["g"]: r["n"] for r in rows.collect()}


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (score of one half or more).

    The language model counts all documents; labels are learned from only where ``crc32(id as
    text) mod 5`` is not 0, on at most ``SAMPLE`` documents of each class, of any length. The score of a text is that of
    its most toxic window. Null and empty texts
    get the score of a text without words; a null id counts as ""; repeated rows and other
    columns are kept (columns named as those added are replaced); repeated labels of an id count as
    their least; without labels the score is one half; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    usable = id_remainder(id, 5) != 0
    model = ToxicityModel(corpus_trigrams(docs, text))
    drawn = labelled_texts(docs, labels, id, text, label, usable, SAMPLE)
    n = {r[0]: r[1] for r in labels.where(id_remainder(id, 5) != 0).groupBy(label).count().collect()}
    model.fit(drawn, (n.get(1, 0) + 1) / (n.get(0, 0) + 1))
    return (
        docs.drop("held_out", "score", "predicted")
        .withColumn("held_out", id_remainder(id, 5) == 0)
        .withColumn("score", model.score(docs.sparkSession, F.col(text)))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def op2_noisy_channel_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return score_toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op2_noisy_channel_toxicity": op2_noisy_channel_toxicity}
ORACLES: dict[str, str] = {}
