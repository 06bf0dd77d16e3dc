"""Sharding by best-fit-decreasing bin packing.

Texts that are equal form an indivisible group. Groups, sorted by size, enter the bin with the least remaining capacity
that still holds them, found in a balanced tree of remaining capacities; with a fixed capacity that keeps the number of
bins low. For a fixed number of bins, groups above the mean of what is left get a bin each, and for the others the
capacity is searched for: the least, to a tolerance, with which all fits the bins left. A bin that this leaves empty takes
half of the fullest.

At scale the packing sees sizes, not groups: best fit places groups of one size into bin after bin, so a histogram of sizes
holds all that it needs, and one step fills a bin with as many of a size as fit. Sizes keep their DIGITS leading bits,
rounded up: exact below 2**DIGITS bytes and to one part in 2**(DIGITS - 1) above, which bounds the histogram whatever the
number of groups. Every group then takes its place in the order of sizes, by a sort in ranges, and its bin from there.

Defined cases: a null text takes OVERHEAD bytes and groups with other nulls; an empty table has no shards. Rows that
repeat are copies of a text. A group larger than the capacity gets a bin of its own. Copies of a row are interchangeable:
they fold before they are shuffled and get a run of slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, repeated, row_digest, spread_join

OVERHEAD = 8
N_SHARDS = 24
#: Leading bits that a size keeps in the histogram.
DIGITS = 14
#: Distinct rows that one part of a shard numbers, about.
PART_ROWS = 200_000
#: Columns that the pipeline's last stage adds.
SHARD, SLOT = "shard", "slot"


class Capacities:
    """Remaining capacities of bins in a balanced (AA) tree, ordered by capacity, then bin."""

    def __init__(self):
        self.root = None

    class Node:
        __slots__ = ("key", "level", "left", "right")

        def __init__(self, key):
            self.key, self.level, self.left, self.right = key, 1, None, None

    @staticmethod
    def _skew(t):
        if t and t.left and t.left.level == t.level:
            left = t.left
            t.left, left.right = left.right, t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t.right and t.right.right and t.level == t.right.right.level:
            right = t.right
            t.right, right.left = right.left, t
            right.level += 1
            return right
        return t

    def add(self, key) -> None:
        def put(t):
            if t is None:
                return self.Node(key)
            if key < t.key:
                t.left = put(t.left)
            else:
                t.right = put(t.right)
            return self._split(self._skew(t))

        self.root = put(self.root)

    def remove(self, key) -> None:
        def least(t):
            while t.left:
                t = t.left
            return t.key

        def cut(t, key):
            if t is None:
                return None
            if key < t.key:
                t.left = cut(t.left, key)
            elif key > t.key:
                t.right = cut(t.right, key)
            elif t.left is None:
                return t.right
            elif t.right is None:
                return t.left
            else:
                t.key = least(t.right)
                t.right = cut(t.right, t.key)
            lower = min(t.left.level if t.left else 0, t.right.level if t.right else 0) + 1
            if lower < t.level:
                t.level = lower
                if t.right and lower < t.right.level:
                    t.right.level = lower
            t = self._skew(t)
            t.right = self._skew(t.right)
            if t.right:
                t.right.right = self._skew(t.right.right)
            t = self._split(t)
            t.right = self._split(t.right)
            return t

        self.root = cut(self.root, key)

    def tightest(self, size: int):
        """The least key whose capacity is at least the size."""
        t, best = self.root, None
        while t:
            if t.key[0] >= size:
                best, t = t.key, t.left
            else:
                t = t.right
        return best


Runs = list[tuple[int, list[tuple[int, int]]]]


def pack(sizes: list[tuple[int, int]], capacity: int) -> tuple[Runs, list[int]]:
    """Best-fit-decreasing of (size, number of groups): for each size, from the largest, the runs (bin, how many), and the
    load of each bin. Of bins with equal room the first is taken."""
    tree, runs, loads = Capacities(), [], []
    for size, count in sorted(sizes, reverse=True):
        own: list[tuple[int, int]] = []
        while count:
            found = tree.tightest(size)
            if found:
                tree.remove(found)
                room, bin_ = found
            else:
                room, bin_ = max(capacity, size), len(loads)
                loads.append(0)
            # Once it holds one, this bin stays the tightest until no more of this size fit.
            n = min(count, room // size)
            own.append((bin_, n))
            loads[bin_] += n * size
            count -= n
            tree.add((room - n * size, bin_))
        runs.append((size, own))
    return runs, loads


def _least(sizes: list[tuple[int, int]], n_bins: int) -> tuple[Runs, list[int]]:
    """The least capacity, to one part in a few thousand, with which best-fit-decreasing needs at most n_bins."""
    total = sum(size * count for size, count in sizes)
    low = -(-total // n_bins)
    high = max([low, *(size for size, _ in sizes)])
    best = None
    step = max(1, low // 4096)
    while best is None:
        runs, loads = pack(sizes, high)
        if len(loads) <= n_bins:
            best = runs, loads
        else:
            high += max(step, low // 16)
    while high - low > step:
        middle = (low + high) // 2
        runs, loads = pack(sizes, middle)
        if len(loads) <= n_bins:
            best, high = (runs, loads), middle
        else:
            low = middle
    return best


def _spread(runs: Runs, loads: list[int], n_bins: int) -> None:
    """Each bin that is still empty takes about half of the fullest bin that holds more than one group."""
    groups = sum(n for _, own in runs for _, n in own)
    while len(loads) < min(n_bins, groups):
        held = [0] * len(loads)
        for _, own in runs:
            for bin_, n in own:
                held[bin_] += n
        full, new = max((b for b in range(len(loads)) if held[b] > 1), key=lambda b: (loads[b], -b)), len(loads)
        loads[full] = 0
        loads.append(0)
        for size, own in runs:  # largest first
            for at, (bin_, n) in enumerate(own):
                if bin_ == full:
                    # As many as bring this bin nearest to half of what both then hold.
                    half = loads[full] + loads[new] + n * size
                    stay = min(n, max(0, (half - 2 * loads[full] + size) // (2 * size)))
                    own[at : at + 1] = [(b, k) for b, k in ((full, stay), (new, n - stay)) if k]
                    loads[full] += stay * size
                    loads[new] += (n - stay) * size
                    break


def pack_into(sizes: list[tuple[int, int]], n_bins: int) -> tuple[Runs, list[int]]:
    """Near equal loads in at most n_bins. A group above the mean of what is left gets a bin of its own, repeatedly; the
    others are packed into the bins left, of which none stays empty while there are groups enough."""
    left = {size: count for size, count in sorted(sizes, reverse=True)}
    alone: list[int] = []
    rest = sum(size * count for size, count in left.items())
    groups = sum(left.values())
    for size in list(left):
        while left[size] and len(alone) < min(groups, n_bins - 1) and size * (n_bins - len(alone)) > rest:
            alone.append(size)
            left[size] -= 1
            rest -= size
        if left[size]:
            break
    others = [(size, count) for size, count in left.items() if count]
    runs, loads = _least(others, n_bins - len(alone))
    _spread(runs, loads, n_bins - len(alone))
    whole: dict[int, list[tuple[int, int]]] = {}
    for bin_, size in enumerate(alone):
        whole.setdefault(size, []).append((bin_, 1))
    for size, own in runs:
        whole.setdefault(size, []).extend((len(alone) + bin_, n) for bin_, n in own)
    return sorted(whole.items(), reverse=True), alone + loads


def rounded(size: Column) -> Column:
    """A size up to the next one of DIGITS significant bits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - DIGITS).cast("int")
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return ((F.floor((size - 1) / unit) + 1) * unit).cast("long")


def _keyed(docs: DataFrame, digest: Column) -> DataFrame:
    """doc_id, size, crc, group and kind: copies of a row are those that agree in all of them."""
    text = F.col("text").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")
    group = F.coalesce(F.md5(text.cast("binary")), F.lit("null"))
    return docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("crc"), group.alias("group"), digest.alias("kind"))


def _binned(groups: DataFrame, n_shards: int) -> DataFrame:
    """group, n and shard. groups: group, total (bytes) and n (distinct rows)."""
    spark = groups.sparkSession
    groups = groups.select("group", "n", rounded(F.col("total")).alias("level"))
    ordered = groups.repartitionByRange(F.desc("level"), "group").withColumn("part", F.spark_partition_id())
    ordered = checkpoint(ordered)
    histogram = ordered.groupBy("level").count().toArrow()
    runs, _ = pack_into(list(zip(histogram["level"].to_pylist(), histogram["count"].to_pylist())), n_shards)
    rows, first = [], 0
    for level, own in runs:
        upto, bins = 0, []
        for bin_, n in own:
            upto += n
            bins.append((upto, bin_))
        rows.append((level, first, bins))
        first += upto
    places = F.broadcast(spark.createDataFrame(rows, "level long, first long, bins array<struct<upto: long, bin: int>>"))  # bounded by DIGITS
    before, starts = 0, []
    for part, n in ordered.groupBy("part").count().orderBy("part").collect():  # a row for each partition
        starts.append((part, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("level"), "group"))
    placed = ordered.withColumn("rank", rank).join(starts, "part").join(places, "level")
    at = F.col("start") + F.col("rank") - 1 - F.col("first")
    return placed.select("group", "n", F.filter("bins", lambda b: b["upto"] > at)[0]["bin"].alias("shard"))


def assign(docs: DataFrame, n_shards: int = N_SHARDS, digest: Column | None = None) -> DataFrame:
    """doc_id, size, crc, group, kind, shard, first and n: each distinct row with its shard and its slots [first, first + n).

    digest: what else tells rows apart.
    """
    keys = ["doc_id", "size", "crc", "group", "kind"]
    rows = checkpoint(_keyed(docs, F.lit(0).cast("long") if digest is None else digest).groupBy(*keys).agg(F.count("*").alias("copies")))
    total = rows.count()
    groups = rows.groupBy("group").agg(F.sum(F.col("size") * F.col("copies")).alias("total"), F.count("*").alias("n"))
    binned = checkpoint(_binned(groups, n_shards))
    placed = spread_join(rows, binned, "group", total).drop("n")
    parts = max(1, -(-total // (n_shards * PART_ROWS)))
    placed = checkpoint(placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "group", "kind"), F.lit(parts))))
    counts = placed.groupBy("shard", "part").agg(F.sum("copies").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "part", before.alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "group", "kind").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("copies").over(within), F.lit(0))
    return placed.join(starts, ["shard", "part"]).select(*keys, "shard", first.alias("first"), F.col("copies").alias("n"))


def shard(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    out = repeated(checkpoint(assign(docs, n_shards)), "n")
    slot = (F.col("first") + F.col("copy")).cast("long")
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document whole, with its SHARD and SLOT.

    Copies of a row fold, with their number, and are written out again; the others move once, to meet their shard. Columns
    of those names that the input has are replaced.
    """
    digest = row_digest(docs)
    placed = assign(docs, digest=digest).select(F.col("group").alias("own_group"), F.col("kind").alias("own_kind"), "shard", "first", "n")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    group = F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit("null"))
    rows = docs.select(row.alias("row"), group.alias("group"), digest.alias("kind"))
    # Text and digest name a row; folding and joining by them takes one shuffle of whole rows.
    folded = rows.groupBy("group", "kind").agg(F.first("row").alias("row"))
    met = folded.join(placed, (F.col("group") == F.col("own_group")) & (F.col("kind") == F.col("own_kind")))
    whole = repeated(met.select("row", "shard", "first", "n"), "n")
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in (SHARD, SLOT)]
    return whole.select(*kept, F.col("shard").alias(SHARD), (F.col("first") + F.col("copy")).cast("long").alias(SLOT))
