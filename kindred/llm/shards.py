"""Sharding by minimax contiguous partition, with DataFrame functions only.

Equal texts form an atomic group. Groups stand in the order of the SHA-256 of their text, which is
random, so that the first hexadecimal digits cut the order into 4096 ranges of equal expected size;
range sums and a running sum inside a range give the prefix sum of every group. The smallest
capacity at which a greedy pass needs no more than the wanted number of shards is found by binary
search over capacities. A greedy pass only asks for the last group that ends at or before a
position, so a bounded number of group ends is enough to bound it from both sides; the search fetches
finer ends around the undecided positions until both bounds agree.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import kept_names, text_of
from kindred.session import through_table

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
ENDS = 16384  # group ends fetched in a round, however large the table
SALTS = 64  # parts of a group when its rows are numbered
DIGITS = 3


def prefix_sums(groups: DataFrame) -> DataFrame:
    """Adds ``end`` (bytes up to and with the group) and ``first_row`` (rows before it)."""
    ranged = groups.withColumn("range", F.substring(F.hex("digest"), 1, DIGITS))
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range")
        .agg(F.sum("bytes").alias("b"), F.sum("n").alias("r"))
        .select(
            "range",
            F.coalesce(F.sum("b").over(order), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("r").over(order), F.lit(0)).alias("rows_before"),
        )
    )
    inside = Window.partitionBy("range").orderBy("digest")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most 16 ** DIGITS offsets: safe to broadcast.
    return ranged.join(F.broadcast(offsets), "range").select(
        "digest",
        "bytes",
        "n",
        (F.col("bytes_before") + F.sum("bytes").over(inside)).alias("end"),
        (F.col("rows_before") + F.sum("n").over(inside) - F.col("n")).alias("first_row"),
    )


class _Ends:
    """Known group ends: blocks of (least end, greatest end, number of ends)."""

    def __init__(self, blocks):
        self.blocks = sorted(blocks)
        self.least = [b[0] for b in self.blocks]

    def last(self, position: int) -> tuple[int, int]:
        """Bounds of the last group end at or before ``position``."""
        i = bisect_right(self.least, position) - 1
        if i < 0:
            return 0, 0
        low, high, n = self.blocks[i]
        if position >= high:
            return high, high
        return low, low if n <= 2 else position

    def passes(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of the cuts of a greedy pass."""
        cuts, low, high = [], 0, 0
        for _ in range(shards):
            low, high = self.last(low + capacity)[0], self.last(high + capacity)[1]
            cuts.append((low, high))
        return cuts


def _search(low: int, high: int, good) -> int:
    """The smallest number of [low, high] that is good; ``high`` is."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if good(middle) else (middle + 1, high)
    return low


def minimax_cuts(sums: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the ends of the shards; ``sums`` is a stored table."""
    total, largest = sums.agg(F.max("end"), F.max("bytes")).first()
    if total is None:
        return 0, []
    floor = max(largest, -(-total // shards))

    def fetch(spans):
        parts = max(4, ENDS // len(spans))
        part = F.lit(None).cast("long")
        for i, (a, b) in enumerate(spans):
            width = max(1, -(-(b - a + 1) // parts))
            inside = F.floor((F.col("end") - a) / width) + i * (parts + 1)
            part = F.when(F.col("end").between(a, b), inside).otherwise(part)
        found = sums.groupBy(part.alias("part")).agg(
            F.min("end").alias("a"), F.max("end").alias("b"), F.count(F.lit(1)).alias("n")
        )
        return [(r.a, r.b, r.n) for r in found.where("part is not null").collect()]

    ends = _Ends(fetch([(1, total)]))
    low, high = floor, min(total, floor + largest)
    while True:
        high = _search(low, high, lambda c: ends.passes(c, shards)[-1][0] >= total)
        low = _search(low, high, lambda c: ends.passes(c, shards)[-1][1] >= total)
        first, last = ends.passes(low, shards), ends.passes(high, shards)
        if low == high and all(a == b for a, b in last):
            return high, [a for a, _ in last]
        # Every position that a pass with a capacity in [low, high] may ask for.
        starts = [(0, 0)] + [(f[0], l[1]) for f, l in zip(first, last)]
        spans = []
        for a, b in starts[:-1]:
            touched = [
                x
                for x in ends.blocks
                if x[2] > 2 and x[1] >= a + low and x[0] <= b + high
            ]
            if touched:
                a, b = touched[0][0], touched[-1][1]
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                else:
                    spans.append((a, b))
        outside = [x for x in ends.blocks if not any(a <= x[0] <= b for a, b in spans)]
        ends = _Ends(outside + fetch(spans))


def shard(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Adds a shard to every row; equal texts share one.

    Returns the columns ``keep`` of ``docs`` (with ``_`` added to a name that a result has, until no
    column has it) and ``size`` (UTF-8 bytes of the text plus 1; a null text has none and stands with
    the empty ones), ``text_crc32``, ``law`` (always ``bytes``), ``shard``,
    ``slot`` (position in the shard, from 0 without gaps) and ``grown_shard`` (null under this law).
    No shard exceeds the smallest capacity that a contiguous cut of the ordered groups allows.
    Rows of a group stand by id, a null id first; rows with the same id are numbered in turn. Shards
    stay empty when there are fewer groups. Other columns may have any name.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.struct(*(F.col(c).alias(n) for c, n in zip(keep, kept_names(keep, RESULTS)))).alias("kept"),
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int").alias("salt"),
    )
    cells = through_table(
        rows.groupBy("digest", "salt").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")),
        "cells",
    )
    sums = through_table(
        prefix_sums(cells.groupBy("digest").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))),
        "sums",
    )
    _, cuts = minimax_cuts(sums, shards)
    inner = sorted(set(cuts[:-1]))
    first_rows = {
        r.end: r.next_row
        for r in sums.where(F.col("end").isin(inner))
        .select("end", (F.col("first_row") + F.col("n")).alias("next_row"))
        .collect()
    } if inner else {}
    number = sum((F.when(F.col("end") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0))
    first_row = F.lit(0).cast("long")
    for c in inner:
        first_row = F.when(F.col("end") > c, F.lit(first_rows[c])).otherwise(first_row)
    salted = Window.partitionBy("digest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        cells.select("digest", "salt", "n")
        .join(sums.select("digest", "end", "first_row"), "digest")
        .select(
            "digest",
            "salt",
            number.cast("int").alias("shard"),
            (
                F.col("first_row") - first_row + F.coalesce(F.sum("n").over(salted), F.lit(0))
            ).alias("before"),
        )
    )
    inside = Window.partitionBy("digest", "salt").orderBy("id")
    return rows.join(placed, ["digest", "salt"]).select(
        "kept.*",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
