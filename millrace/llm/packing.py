"""Problem 5: filling training sequences of fixed capacity with records.

Cost-balanced packing: a record of n units costs ``linear * n + quadratic *
n**2`` (attention inside a record is quadratic, sequences pack records without
attention between them). Records go, in descending order of size, to the
sequence of lowest cost that still has room.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pieces a packing group: large enough that the one sequence a group may
#: leave part empty hardly counts, small enough for one task's memory.
GROUP_PIECES = 25_000
#: Cost of attention against the rest of a layer, 4 * n * width against
#: 24 * width**2 operations a token, with units taken as tokens.
QUADRATIC = 1 / (6 * 1536)


def pack_sizes(sizes: list[int], capacity: int, linear: float, quadratic: float, start: int) -> tuple[list[int], int]:
    """The sequence of each piece, and the number of sequences.

    ``sizes`` must be descending and at most ``capacity``. Beginning with
    ``start`` empty sequences, each piece goes to the one of lowest cost among
    those with room for it; a further one is opened only if none has room.

    Sequences with room for the present piece are a heap by cost. As sizes
    descend, one that has room keeps it until it is chosen; those without
    wait in a heap by room until pieces are small enough. Every piece takes
    logarithmic time.
    """
    room, cost, place = [capacity] * start, [0.0] * start, []
    ready = [(0.0, k) for k in range(start)]
    waiting: list[tuple[int, int]] = []
    for size in sizes:
        while waiting and -waiting[0][0] >= size:
            k = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (cost[k], k))
        if ready:
            k = heapq.heappop(ready)[1]
        elif not size and room:
            k = 0
        else:
            k = len(room)
            room.append(capacity)
            cost.append(0.0)
        room[k] -= size
        cost[k] += linear * size + quadratic * size * size
        place.append(k)
        if room[k] >= size:
            heapq.heappush(ready, (cost[k], k))
        elif room[k] > 0:
            heapq.heappush(waiting, (-room[k], k))
    return place, len(room)


def _pack_group(capacity: int, linear: float, quadratic: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        p = pieces.sort_values(["n", "id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        sizes = p["n"].tolist()
        # all needed sequences open from the start, for balance; or, if that takes fewer, opened when none has room
        tries = [pack_sizes(sizes, capacity, linear, quadratic, start) for start in (max(1, -(-sum(sizes) // capacity)), 0)]
        place = min(tries, key=lambda t: t[1])[0]
        # sequences that stayed empty have no number
        p["seq"] = pd.Series(place, dtype="int64").rank(method="dense").astype("int64") - 1
        p["offset"] = p.groupby("seq")["n"].cumsum() - p["n"]
        return p[["grp", "id", "piece", "n", "seq", "offset"]]

    return run


def pack(records: DataFrame, capacity: int, materialise, linear: float = 1.0, quadratic: float = QUADRATIC, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Places every record in a sequence of at most ``capacity`` units.

    ``records``: ``id`` (unique long), ``n`` (units; null counts as 0).
    Returns ``id, piece, length, sequence, offset``: ``sequence`` numbers are
    global and without gaps from 0, ``offset`` is where the piece starts in
    its sequence. Only records longer than ``capacity`` are divided, into
    full pieces and a rest.

    Defined cases: records of length 0 take no room and go to some sequence
    at its current end; repeated rows are packed like others; rows without id
    are left out; an empty table
    gives an empty result; extra columns are ignored.

    Scale: pieces are hashed into groups of about ``group_pieces`` (each with
    the same mix of sizes), packed in one task each; nothing but group
    counts (one row a group) crosses groups. Full pieces need no packing and
    stay out of the groups.
    """
    records = records.where(F.col("id").isNotNull())
    sized = records.select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
    whole = F.floor(F.col("n") / capacity).cast("int")
    last = F.when((F.col("n") % capacity > 0) | (F.col("n") == 0), whole).otherwise(whole - 1)
    pieces = sized.select("id", "n", F.posexplode(F.sequence(F.lit(0), last)).alias("piece", "_x"))
    pieces = pieces.select("id", "piece", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).alias("n"))
    total = records.count()
    groups = max(1, -(-total // group_pieces))
    full, part = pieces.where(F.col("n") == capacity), pieces.where(F.col("n") < capacity)
    part = part.withColumn("grp", F.pmod(F.xxhash64("id", "piece"), F.lit(groups)).cast("int"))
    part = part.repartition(groups, "grp")  # a number of its own keeps small groups apart
    packed = materialise(part.groupBy("grp").applyInPandas(_pack_group(capacity, linear, quadratic), "grp int, id long, piece int, n long, seq long, offset long"), "packed")
    used = packed.groupBy("grp").agg((F.max("seq") + 1).cast("long").alias("_used"))
    order = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)  # one row a group
    starts = used.withColumn("_start", F.coalesce(F.sum("_used").over(order), F.lit(0).cast("long"))).select("grp", "_start", "_used")
    placed = packed.join(starts, "grp").select("id", "piece", F.col("n").alias("length"), (F.col("seq") + F.col("_start")).alias("sequence"), "offset")
    # full pieces are numbered after the packed ones: per hash bucket, then within
    spread = full.withColumn("_b", F.pmod(F.xxhash64("id", "piece"), F.lit(4096)).cast("int"))
    counts = spread.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    base = starts.agg(F.coalesce(F.sum("_used"), F.lit(0)).alias("_base"))
    firsts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # at most 4,096 rows
    firsts = firsts.join(F.broadcast(base)).select("_b", (F.col("_first") + F.col("_base")).alias("_first"))
    numbered = spread.join(F.broadcast(firsts), "_b").withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("id", "piece")) - 1)
    alone = numbered.select("id", "piece", F.col("n").alias("length"), (F.col("_first") + F.col("_r")).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)
