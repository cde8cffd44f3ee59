"""Quality by compression: which dictionary shortens a text more, that of good or of bad text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskspark.llm import logistic
from riskspark.llm.common import id_remainder, labelled_texts, small_batches, table, utf8

#: Labelled documents of each class used at most for the two dictionaries, and as many for calibration.
SAMPLE = 2_000
#: Bytes of a document that train a dictionary at most; of a longer one, pieces spread evenly over it.
SAMPLE_BYTES = 65_536
#: Texts are compressed in pieces of so many bytes, so that a dictionary helps everywhere and not at the head only.
PIECE = 2_048
DICTIONARY_BYTES = 112_640
LEVEL = 3


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; of too few samples, their bytes themselves."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(samples)[-DICTIONARY_BYTES:] or b"\n" * 8
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def spread(text: bytes) -> bytes:
    """A text of up to ``SAMPLE_BYTES`` bytes, or as many bytes in pieces spread evenly over a longer one."""
    if len(text) <= SAMPLE_BYTES:
        return text
    n = SAMPLE_BYTES // PIECE
    starts = [i * (len(text) - PIECE) // (n - 1) for i in range(n)]
    return b"".join(text[a : a + PIECE] for a in starts)


def measures(good: bytes, bad: bytes, raw: tuple[bool, bool]) -> Callable[[bytes], tuple[float, ...]]:
    """A function from text bytes to the normalised difference and the compressed sizes per byte.

    Sizes are sums over all pieces of the text, so each part has an equal say however long the text is.
    """
    kinds = [zstandard.DICT_TYPE_RAWCONTENT if r else zstandard.DICT_TYPE_FULLDICT for r in raw]
    dictionaries = [
        zstandard.ZstdCompressionDict(d, dict_type=k) for d, k in zip((good, bad), kinds)
    ]
    for d in dictionaries:
        d.precompute_compress(level=LEVEL)
    by_good, by_bad = (zstandard.ZstdCompressor(level=LEVEL, dict_data=d) for d in dictionaries)
    plain = zstandard.ZstdCompressor(level=LEVEL)

    def of(text: bytes) -> tuple[float, ...]:
        n = len(text) + 1
        pieces = [text[at : at + PIECE] for at in range(0, len(text), PIECE)] or [b""]
        g, b, p = (sum(len(c.compress(piece)) for piece in pieces) for c in (by_good, by_bad, plain))
        # Beyond one piece the length says nothing more about the sizes per byte.
        return (b - g) / (b + g), np.log(min(n, PIECE)), p / n, g / n, b / n

    return of


class CompressionClassifier:
    """Two dictionaries and the weights that turn compressed sizes into a score."""

    def __init__(self, good: list[bytes], bad: list[bytes]):
        trained = [_dictionary(good), _dictionary(bad)]
        # A trained dictionary has an id, raw content has none.
        self.raw = tuple(d.dict_id() == 0 for d in trained)
        self.good, self.bad = (d.as_bytes() for d in trained)
        self.weights, self.intercept = np.zeros(5), 0.0

    def calibrate(self, rows: DataFrame, id: str, text: str, label: str) -> None:
        """Fit the weights; of the rows only five numbers each reach the driver."""
        good, bad, raw = self.good, self.bad, self.raw

        @F.pandas_udf("array<double>")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            measure = measures(good, bad, raw)
            for texts in batches:
                yield pd.Series([list(map(float, measure(utf8(t)))) for t in texts], dtype=object)

        found = rows.select(F.col(id).cast("string"), label, of(text)).collect()
        found.sort(key=lambda r: (-r[1], r[0]))
        x = np.array([r[2] for r in found], float).reshape(len(found), 5)
        self.weights, self.intercept = logistic.fit(x, np.array([r[1] for r in found], float))

    def score(self, text: Column) -> Column:
        """Calibrated probability that a text has label 1; null counts as empty."""
        good, bad, raw = self.good, self.bad, self.raw
        weights, intercept = self.weights, self.intercept

        @F.pandas_udf(DoubleType())
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            measure = measures(good, bad, raw)
            for texts in batches:
                x = np.array([measure(utf8(t)) for t in texts], float).reshape(len(texts), 5)
                yield pd.Series(logistic.score(x, weights, intercept))

        return of(text)


def learn(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, usable: Column
) -> CompressionClassifier:
    """Fit on a bounded sample of labelled rows of any length.

    For each class at most ``2 * SAMPLE`` documents are drawn, one half for the dictionary (``SAMPLE_BYTES`` bytes of
    each at most reach the driver) and the other for calibration, measured whole where it lies. Without any
    label every score is one half.
    """
    drawn = labelled_texts(docs, labels, id, text, label, usable, 2 * SAMPLE)

    @F.pandas_udf("binary")
    def part(texts: pd.Series) -> pd.Series:
        return pd.Series([spread(utf8(t)) for t in texts], dtype=object)

    half = drawn.where("__half = 0").select(F.col("__id").cast("string"), "__y", part("__text")).collect()
    half.sort(key=lambda r: r[0])
    model = CompressionClassifier(*([bytes(r[2]) for r in half if r[1] == y] for y in (1, 0)))
    model.calibrate(drawn.where("__half = 1"), "__id", "__text", "__y")
    return model


def classify(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (score of one half or more).

    Learns only from rows whose ``crc32(id as text) mod 3`` is not 1, and scores whole texts by
    nothing but their bytes. Null and empty texts get the score of an empty text; null ids count
    as the id "" ; repeated rows and other columns are kept (columns named as those added are
    replaced); repeated labels of an id count as their least; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    model = learn(docs, labels, id, text, label, id_remainder(id, 3) != 1)
    return (
        docs.drop("held_out", "score", "predicted")
        .withColumn("held_out", id_remainder(id, 3) == 1)
        .withColumn("score", model.score(F.col(text)))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def op7_compression_quality(spark, sf_dir):
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op7_compression_quality": op7_compression_quality}
ORACLES: dict[str, str] = {}
