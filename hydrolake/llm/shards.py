"""Minimax contiguous shards: equal texts stay together, the largest shard is as small as can be."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolake.llm.common import bucket, written

#: Atomic units: texts dealt by hash. Their number, not the data's size, bounds what the driver
#: holds. CELLS: parts of a shard that are numbered on their own.
UNITS, CELLS = 1 << 16, 1024


def needed(prefix: list[int], start: int, capacity: int, most: int) -> int:
    """Shards that greedy filling up to ``capacity`` takes from ``start`` on (``most`` + 1: too many)."""
    n, i = 0, start
    while i < len(prefix) - 1 and n <= most:
        i, n = max(i, bisect_right(prefix, prefix[i] + capacity) - 1), n + 1
        if i < len(prefix) - 1 and prefix[i + 1] - prefix[i] > capacity:
            return most + 1
    return n


def cuts(sizes: list[int], shards: int) -> list[int]:
    """End (exclusive) of each shard over ordered atomic sizes.

    The smallest feasible capacity is searched by halving, a greedy fill tells whether one is
    feasible, and the first shard is cut there; the rest is searched anew for the shards left, so
    that one large unit does not let the others run uneven.
    """
    prefix, ends, start = [0, *accumulate(sizes)], [], 0
    for left in range(shards, 0, -1):
        low = max(max(sizes[start:], default=0), -((prefix[start] - prefix[-1]) // left))
        high = max(low, prefix[-1] - prefix[start])
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if needed(prefix, start, mid, left) <= left else (mid + 1, high)
        start = max(start, bisect_right(prefix, prefix[start] + low) - 1)
        ends.append(start)
    return ends


def places(units: list[tuple[int, int]], shards: int) -> tuple[dict[int, int], list[int]]:
    """Shard of each unit that is larger than an even share, and of the others the first unit
    number of each following shard. The large ones come first in the order, by size."""
    even = sum(s for _, s in units) / shards
    large = sorted((u for u in units if u[1] > even), key=lambda u: (-u[1], u[0]))[:shards - 1]
    alone = {u for u, _ in large}
    rest = sorted(u for u in units if u[0] not in alone)
    ordered = large + rest
    ends = cuts([s for _, s in ordered], shards)
    shard_of, first, start = {}, [], 0
    for shard, end in enumerate(ends):
        for u, _ in ordered[start:min(end, len(large))]:
            shard_of[u] = shard
        if shard:  # the first unit, in number order, that lies in this shard or a later one
            first.append(ordered[max(start, len(large))][0] if max(start, len(large)) < len(ordered) else UNITS)
        start = end
    return shard_of, first


def assign(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row; law ``bytes``.

    Size is the text's UTF-8 bytes plus 8. Texts are dealt to 65,536 units by hash, so equal texts
    share a unit and no unit is ever split; shards are ranges of units, cut by ``cuts``. Units, not
    texts, are what the driver orders: 65,536 sizes at any scale, each about a 2,700th of a
    shard, unless copies of one text make it larger. Slots number each shard's rows without gaps:
    rows are numbered inside ``CELLS`` parts of a shard (by a hash of the id, so a text that a
    third of all rows share is spread) and the parts' counts are added up. Texts are read once and
    never shuffled; only DataFrame functions run.

    A null text counts as an empty one. Equal rows are counted each. Null ids come first in their
    cell. Fewer units than shards leave shards empty. An empty table gives no rows.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = written(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(whole) + 8).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), bucket(UNITS, whole).alias("unit"),
        bucket(CELLS, F.col(doc_id)).alias("cell")), "rows")
    units = rows.groupBy("unit").agg(F.sum("size")).collect()
    shard_of, first = places([(r[0], r[1]) for r in units], shards)
    shard: Column = sum(((F.col("unit") >= u).cast("int") for u in first), F.lit(0))
    for unit, at in shard_of.items():
        shard = F.when(F.col("unit") == unit, at).otherwise(shard)
    rows = rows.withColumn("shard", shard.cast("int"))
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("nth", F.row_number().over(inside) - 1).join(offsets, ["shard", "cell"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           (F.col("offset") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
