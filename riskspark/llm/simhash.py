"""SimHash near-duplicates by segment-popcount embedding.

The Manhattan distance of per-segment bit counts is a lower bound of the Hamming distance.
With 32 segments of two bits the embedding of a fingerprint packs into one long. Its 32
axes are dealt to six groups; a distance of two changes at most two groups, so two linked
fingerprints share a grid cell in at least one of the 15 projections to four groups.
Cells are range-joined under the lower bound and then verified bit by bit.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from riskspark.llm.common import small_batches, stored, table, utf8
from riskspark.llm.graph import components

DISTANCE = 2
GROUPS = 6
#: Fingerprints of cells with more than this many meet in Hamming balls instead of pairs.
CELL = 16
_EVEN = 0x5555555555555555


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``words`` words, in order; of fewer words, the sequence."""
    tokens = utf8(text).lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    last = ends[min(words, len(tokens)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n
    )


def fingerprint_of(hashes: np.ndarray) -> int:
    """64-bit SimHash of shingle hashes: a bit is 1 if it is set in over half of them; 0 without any."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        block = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: str | Column, words: int = 3) -> Column:
    """The SimHash of a text column as a long."""

    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(shingle_hashes(t, words)) for t in texts], dtype="int64")

    return of(text)


def _projections() -> list[int]:
    """Masks over the packed embedding, each without two of the six groups of axes."""
    groups = [sum(3 << (2 * s) for s in range(g, 32, GROUPS)) for g in range(GROUPS)]
    return [
        _signed(sum(m for g, m in enumerate(groups) if g not in out))
        for out in combinations(range(GROUPS), DISTANCE)
    ]


def embedding(f: Column) -> Column:
    """Bit counts 0, 1, 2 of the 32 two-bit segments, written as 00, 01, 11 in each segment."""
    even, next_bit = F.lit(_EVEN), F.shiftrightunsigned(f, 1)
    some = f.bitwiseOR(next_bit).bitwiseAND(even)
    both = f.bitwiseAND(next_bit).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings: in this writing, the number of bits that differ."""
    return F.bit_count(a.bitwiseXOR(b))


def links(fingerprints: DataFrame) -> DataFrame:
    """All links ``u``, ``v`` needed to connect distinct fingerprints at two or fewer differing bits.

    ``fingerprints`` has a long column ``f`` of distinct values. In a cell of at most
    ``CELL`` members pairs are tested. Members of fuller cells are sent to their Hamming
    ball of radius 1: two fingerprints differ in at most two bits exactly if their balls
    share a centre, a centre has at most 65 of them, and these form a star. So the rows
    grow with the number of fingerprints, not of pairs, and no link is lost.
    """
    cells = stored(
        fingerprints.select(
            "f",
            F.posexplode(
                F.array(*[embedding(F.col("f")).bitwiseAND(F.lit(m)) for m in _projections()])
            ).alias("p", "cell"),
        ),
        "grid-cells",
    )
    sizes = cells.groupBy("p", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that the join reads two plain exchanges, whose large partitions Spark can split.
    sizes = stored(sizes, "cell-sizes")
    shared = stored(cells.join(sizes, ["p", "cell"]), "shared-cells")
    members = (
        shared.where(F.col("n") <= CELL).groupBy("p", "cell").agg(F.collect_list("f").alias("fs"))
    )
    pairs = members.select("fs", F.explode("fs").alias("u")).select("u", F.explode("fs").alias("v"))
    close = (
        pairs.where("u < v")
        .where(manhattan(embedding(F.col("u")), embedding(F.col("v"))) <= DISTANCE)
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)
    )
    ball = F.array(F.col("f"), *[F.col("f").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    stars = (
        shared.where(F.col("n") > CELL)
        .select("f")
        .distinct()
        .select("f", F.explode(ball).alias("centre"))
        .groupBy("centre")
        .agg(F.collect_list("f").alias("fs"))
        .where(F.size("fs") > 1)
        .select(F.array_min("fs").alias("u"), F.explode("fs").alias("v"))
        .where("u <> v")
    )
    return close.union(stars).distinct()


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """``f`` and ``component``, the least fingerprint it reaches, of all distinct fingerprints of a column ``f``."""
    classes = stored(prints.select("f").distinct(), "simhash-classes")
    reached = components(links(classes)).withColumnRenamed("node", "f")
    found = classes.join(reached, "f", "left").select("f", F.coalesce("component", "f").alias("component"))
    return stored(found, "simhash-components")


def near_duplicates(docs: DataFrame, id: str, text: str, words: int = 3) -> DataFrame:
    """Groups of documents whose SimHashes differ in two or fewer bits, directly or through others.

    Returns ``id``, ``f`` (the fingerprint as a long) and ``component_id``, the least id
    that can be reached. One row per input row: equal texts are one fingerprint and are
    never paired. Null and empty texts have fingerprint 0 and are linked like others;
    repeated rows are kept; ids may be null and are then no component's least id unless
    it has no other; an empty table gives an empty one. Other columns are not returned.
    """
    small_batches(docs.sparkSession)
    prints = stored(
        docs.select(F.col(id).alias("__id"), fingerprint(F.col(text), words).alias("f")), "simhash"
    )
    reached = fingerprint_components(prints)
    least = prints.groupBy("f").agg(F.min("__id").alias("least")).join(reached, "f")
    least = stored(least.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    named = reached.join(least, "component").select("f", "component_id")
    return prints.join(named, "f").select(F.col("__id").alias(id), "f", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """One row of each group of :func:`near_duplicates`: that of the least id, of its rows the one with the least text key.

    Groups are groups of texts, so an id with texts of several groups keeps a row in each that it leads, and of texts with null ids
    one of each group stays; a null id leads a group only if no row has another. All columns are kept, whatever their names. Of
    repeated rows, and of rows that differ only in other columns, one stays. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"),
        F.col(f"`{id}`").alias("id"),
        F.xxhash64(body).alias("k1"),
        F.xxhash64(F.lit("second"), body).alias("k2"),
    )
    prints = docs.select(
        F.col(f"`{id}`").alias("id"),
        F.xxhash64(body).alias("k1"),
        F.xxhash64(F.lit("second"), body).alias("k2"),
        fingerprint(body, words).alias("f"),
    )
    prints = stored(prints, "simhash")
    reached = fingerprint_components(prints)
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2"))
    # Least rows of fingerprints first, so that a large group is combined before it is shuffled.
    first = stored(prints.groupBy("f").agg(lead.alias("lead")), "least-rows").join(reached, "f")
    first = first.groupBy("component").agg(F.min("lead").alias("lead")).select("lead.id", "lead.k1", "lead.k2")
    kept = stored(first, "kept-documents").alias("kept")
    same = F.col("all.id").eqNullSafe(F.col("kept.id"))
    for k in ("k1", "k2"):
        same = same & (F.col(f"all.{k}") == F.col(f"kept.{k}"))
    rows = keyed.alias("all").join(kept, same, "left_semi")
    return rows.dropDuplicates(["id", "k1", "k2"]).select("rest.*")


def op9_simhash_components(spark, sf_dir):
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, "doc_id", "text", words=3).select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op9_simhash_components": op9_simhash_components}
ORACLES: dict[str, str] = {}
