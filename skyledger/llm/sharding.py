"""Sharding by best-fit-decreasing bin packing.

Documents of equal text form an indivisible group. Groups, from the largest
down, enter the shard with the tightest room that still takes them; rooms are
kept in a balanced tree. The shard capacity is the smallest (found by
bisection) at which the asked number of shards suffices, so sizes come out
near equal.

Groups of one size are interchangeable, so the packing runs on (size, number
of groups): sizes are rounded up to PRECISION bits, which leaves at most
2^PRECISION classes for each power of two however many documents there are.
Only that table reaches the driver; group ranks within a class, shard lookup
and slots are joins and windows over bounded buckets. A group that alone is
over an even share of all bytes (at most one per shard can be) is dealt out in
parts by a hash of doc_id, since no shard could take it whole.

Defined results: a null text counts as empty (a group of its own), so its size
is the fixed cost alone; rows that agree in doc_id and text are rows of the same group, each with its
own slot; equal sizes rank by text hash; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

OVERHEAD, PRECISION, ROWS_PER_BUCKET = 16, 12, 500_000


class Rooms:
    """Remaining capacities in a balanced search tree (a treap whose
    priorities are hashes of the shard): insert, remove, tightest fit."""

    def __init__(self) -> None:
        self.root: list | None = None  # node: [key, priority, left, right]

    def _split(self, node: list | None, key: tuple) -> tuple[list | None, list | None]:
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, room: int, shard: int) -> None:
        left, right = self._split(self.root, (room, shard))
        node = [(room, shard), (shard * 0x9E3779B97F4A7C15 ^ 0x5BD1E995) % (1 << 61), None, None]
        self.root = self._join(self._join(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and give the smallest (room, shard) with room for ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        parent, node = None, right
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            right = node[3]
        else:
            parent[2] = node[3]
        self.root = self._join(left, right)
        return node[0]


def best_fit(classes: list[tuple[int, int]], capacity: int, shards: int) -> list[tuple[int, int, int, int]] | None:
    """Runs (size, first rank, end rank, shard) for ``classes`` (size, groups)
    in falling size, or None if ``shards`` of ``capacity`` don't suffice. A
    shard that has taken one group of a size stays the tightest for the next,
    so equal groups enter it until it is full."""
    rooms, runs, opened = Rooms(), [], 0
    for size, groups in classes:
        rank = 0
        while rank < groups:
            found = rooms.take(size)
            if found is None:
                if opened == shards or size > capacity:
                    return None
                found = (capacity, opened)
                opened += 1
            room, shard = found
            n = min(groups - rank, room // size)
            runs.append((size, rank, rank + n, shard))
            rooms.add(room - n * size, shard)
            rank += n
    return runs


def pack(classes: list[tuple[int, int]], shards: int) -> tuple[int, list[tuple[int, int, int, int]]]:
    """The smallest capacity that suffices, and its runs."""
    classes = sorted(classes, reverse=True)
    total = sum(s * n for s, n in classes)
    low = max(-(-total // shards), classes[0][0] if classes else 1, 1)
    high, runs = low, best_fit(classes, low, shards)
    while runs is None:
        low, high = high + 1, high + max(1, high // 64)
        runs = best_fit(classes, high, shards)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(classes, middle, shards)
        if tried is None:
            low = middle + 1
        else:
            high, runs = middle, tried
    return high, runs


def size_class(size: Column) -> Column:
    """``size`` rounded up to PRECISION significant bits."""
    shift = F.greatest(F.length(F.bin(size)) - PRECISION, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return (F.ceil(size / step) * step).cast("long")


def _ranked(rows: DataFrame, keys: list[str], order: list[str], buckets: int, name: str) -> DataFrame:
    """Adds ``name``: gapless rank from 0 within ``keys``. Rows are numbered
    inside hash buckets of bounded size, then shifted by the buckets before."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = rows.withColumn("_in", F.row_number().over(inside) - 1)
    return numbered.join(shift, [*keys, "_bucket"]).withColumn(name, (F.col("_in") + F.col("_shift")).cast("long")) \
        .drop("_bucket", "_in", "_shift")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row."""
    spark = docs.sparkSession
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")
    rows = stored(docs.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"),
        F.xxhash64(F.lit(3), "doc_id", F.monotonically_increasing_id()).alias("own")), "shard-rows")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, -(-n // (ROWS_PER_BUCKET * shards)) * 4)
    share = max(1, total // shards)
    group = ["h1", "h2", "size"]
    sums = rows.groupBy(*group).agg(F.count("*").alias("n"))
    # At most ``shards`` groups are over an even share. Their parts are about a 16th of a share.
    parts = F.ceil(F.col("size") * F.col("n") / F.lit(max(1, share // 16))).cast("int")
    over = sums.filter(F.col("size") * F.col("n") > share).select(*group, parts.alias("parts"))
    over = spark.createDataFrame(over.collect(), over.schema)
    rows = rows.join(F.broadcast(over), group, "left") \
        .withColumn("part", F.coalesce(F.pmod(F.xxhash64(F.lit(4), "own"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    unit = [*group, "part"]
    units = rows.groupBy(*unit).agg(F.count("*").alias("n")).withColumn("class", size_class(F.col("size") * F.col("n")))
    units = stored(_ranked(units, ["class"], unit, buckets, "rank"), "shard-units")
    classes = [(r["class"], r.n) for r in units.groupBy("class").agg(F.count("*").alias("n")).collect()]
    _, runs = pack(classes, shards)
    where = F.broadcast(spark.createDataFrame(runs or [(0, 0, 0, 0)], "class long, first long, end long, shard int"))
    placed = units.join(where, "class").filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    # Keys with over a thousandth of all rows: at most a thousand, so they may be broadcast; the others are joined by shuffle.
    placed = stored(placed.select(*unit, "n", "shard"), "shard-placed")
    hot = placed.filter(F.col("n") > n / 1000).drop("n")
    hot = F.broadcast(spark.createDataFrame(hot.collect(), hot.schema).withColumnRenamed("shard", "hot_shard"))
    marked = rows.join(hot, unit, "left")
    cold = marked.filter(F.col("hot_shard").isNull()).drop("hot_shard").join(placed.drop("n"), unit)
    done = marked.filter(F.col("hot_shard").isNotNull()).withColumnRenamed("hot_shard", "shard") \
        .unionByName(cold).select("doc_id", "size", "text_crc32", "shard", "own")
    return _ranked(done, ["shard"], ["doc_id", "own"], max(16, buckets), "slot").drop("own")
