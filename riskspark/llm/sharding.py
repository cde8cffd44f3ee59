"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import stored, table

#: Ring positions of one shard. They depend on the shard's number only, so a shard
#: keeps its places when others come or go.
VIRTUAL_NODES = 128
#: An arc with more than its even share of rows is cut into slices of about that share / SLICES.
SLICES = 4
#: Equal rows are dealt out in pieces of this many.
PIECE = 10_000
#: Ring positions have 52 bits, so that doubles hold them exactly.
_SHIFT = 12


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[list[int], list[int]]:
    """Ascending ends of the arcs and the shard that owns each of them."""
    points = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            points.setdefault(xxhash.xxh64_intdigest(f"{shard}:{node}", 7) >> _SHIFT, shard)
    ends = sorted(points)
    return ends, [points[e] for e in ends]


def capacities(total: int, shards: int, epsilon: float) -> list[int]:
    """Rows each shard may hold: ``1 + epsilon`` times its share, an even deal at least.

    With ``epsilon = 0`` they sum to the total, so counts are at most one apart.
    """
    even, rest = divmod(total, shards)
    return [max(even + (s < rest), int((1 + epsilon) * total / shards)) for s in range(shards)]


def flow(counts: list[int], owners: list[int], limits: list[int]) -> list[list[tuple[int, int]]]:
    """For each arc the pieces ``(shard, rows)`` that its rows are dealt into, by rank.

    Every arc offers its rows to the shard that owns it. A full shard passes the rest on
    to the next arc clockwise whose shard has room, wave after wave.
    """
    arcs, room = len(counts), list(limits)
    pieces: list[list[tuple[int, int]]] = [[] for _ in counts]
    waiting = [[(a, n)] if n else [] for a, n in enumerate(counts)]
    while any(waiting):
        passed: list[list[tuple[int, int]]] = [[] for _ in counts]
        for arc, queue in enumerate(waiting):
            for origin, n in queue:
                taken = min(n, room[owners[arc]])
                if taken:
                    room[owners[arc]] -= taken
                    pieces[origin].append((owners[arc], taken))
                if n > taken:
                    passed[arc].append((origin, n - taken))
        # From behind, twice round: the next arc clockwise that has room.
        goal, onward = -1, [-1] * arcs
        for step in range(2 * arcs - 1, -1, -1):
            onward[step % arcs] = goal
            if room[owners[step % arcs]]:
                goal = step % arcs
        waiting = [[] for _ in counts]
        for arc, queue in enumerate(passed):
            for piece in queue:
                waiting[onward[arc]].append(piece)
    return pieces


def assign_shards(
    df: DataFrame,
    key: str,
    shards: int,
    epsilon: float = 0.05,
    virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """Deal rows into ``shards`` shards; adds ``shard int`` and ``slot long`` (gapless from 0).

    A row's place on the ring is the hash of its key. A shard takes the rows of its own
    arcs up to ``1 + epsilon`` times the even share; what is beyond goes on clockwise, so
    one shard more moves little besides the rows it takes. The order within an arc
    is that of place and columns, so the result depends on the rows only.

    ``df`` should hold ids and sizes, not texts. The driver sees one count per
    slice of an arc: at most ``(SLICES + 1) * shards * virtual_nodes`` numbers, whatever
    the input. An arc with a hot key is cut into slices by a hash of all columns; equal
    rows are counted before they are shuffled and dealt out in pieces.

    Null keys have a place of their own; repeated rows are all kept, each with its slot;
    an empty table gives an empty one. Columns named ``shard`` or ``slot`` are replaced, all others stay, whatever their names.
    """
    df = df.drop("shard", "slot")
    names, spark = df.columns, df.sparkSession
    # Names of this function's own, so that no given one clashes with those it adds.
    columns = [f"c{i}" for i in range(len(names))]
    key = columns[names.index(key)]
    df = df.toDF(*columns)
    ends, owners = ring(shards, virtual_nodes)
    arcs = len(ends)
    hashed = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\x00")))
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    rows = rows.withColumn("__place", F.shiftrightunsigned(hashed, _SHIFT).cast("double"))
    rows = (
        Bucketizer(
            splits=[-float("inf"), *map(float, ends), float("inf")],
            inputCol="__place",
            outputCol="__arc",
        )
        .transform(rows)
        .withColumn("__arc", (F.col("__arc") % arcs).cast("int"))
    )
    rows = stored(rows, "ring-rows")

    counts = [0] * arcs
    for arc, n in rows.groupBy("__arc").agg(F.sum("__n")).collect():
        counts[arc] = n
    total = sum(counts)
    slices = [1 + SLICES * n * arcs // max(total, 1) for n in counts]
    # A hot arc has many slices; the lookup of how many is one number per arc.
    width = F.element_at(F.array(*map(F.lit, slices)), F.col("__arc") + 1)
    rows = rows.withColumn("__slice", F.pmod(F.xxhash64(*columns), width).cast("int"))
    cells: list[dict[int, int]] = [{} for _ in counts]
    for arc, part, n in rows.groupBy("__arc", "__slice").agg(F.sum("__n")).collect():
        cells[arc][part] = n

    # Ranks below ``upto`` of a slice go to ``shard``, beginning at slot ``base``.
    filled = [0] * shards
    plan = []
    for arc, pieces in enumerate(flow(counts, owners, capacities(total, shards, epsilon))):
        queue = list(reversed(pieces))
        for part in sorted(cells[arc]):
            left, rank, deals = cells[arc][part], 0, []
            while left:
                shard, n = queue.pop()
                taken = min(n, left)
                deals.append((rank + taken, shard, filled[shard] - rank))
                filled[shard] += taken
                rank, left = rank + taken, left - taken
                if n > taken:
                    queue.append((shard, n - taken))
            plan.append((arc, part, deals))
    # At most one row per slice of an arc, so it is small for any input.
    plan_frame = spark.createDataFrame(
        plan, "__arc int, __slice int, __deals array<struct<upto:long,shard:int,base:long>>"
    )
    before = Window.partitionBy("__arc", "__slice").orderBy("__place", *columns)
    ranked = rows.withColumn(
        "__first",
        F.coalesce(F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    pieces_of = F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / PIECE)))
    heavy = rows.agg(F.max("__n")).first()[0] or 0
    ranked = ranked.select("*", pieces_of.alias("__piece"))
    if heavy > PIECE:
        ranked = ranked.repartition("__arc", "__slice", "__first", "__piece")
    begin = F.col("__piece") * PIECE
    end = F.least(begin + PIECE, F.col("__n")) - 1
    ranked = ranked.select("*", F.explode(F.sequence(begin, end)).alias("__step")).withColumn(
        "__rank", F.col("__first") + F.col("__step")
    )
    deal = F.filter("__deals", lambda d: F.col("__rank") < d["upto"])[0]
    dealt = (
        ranked.join(F.broadcast(plan_frame), ["__arc", "__slice"])
        .withColumn("__deal", deal)
        .select(
            *columns,
            F.col("__deal.shard").alias("shard"),
            (F.col("__deal.base") + F.col("__rank")).alias("slot"),
        )
    )
    return dealt.toDF(*names, "shard", "slot")


def op1_ring_shards(spark, sf_dir):
    """All documents in 40 shards, counts at most one apart (``rows``)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return assign_shards(sized, "doc_id", 40, epsilon=0.0).withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )


QUERIES = {"op1_ring_shards": op1_ring_shards}
ORACLES: dict[str, str] = {}
