"""Shards are balanced, also when one group of equal texts is larger than a mean shard."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orrerium.llm import common, sharding


def histogram(sizes):
    return list(Counter(sizes).items())


def loads_of(runs):
    out = defaultdict(int)
    for size, own in runs:
        for bin_, n in own:
            out[bin_] += size * n
    return out


@pytest.mark.parametrize("share", [0.05, 0.09, 1 / 3, 0.9])
def test_a_large_group_leaves_no_bin_empty(share):
    rng = random.Random(3)
    sizes = [rng.randrange(50, 150) for _ in range(4000)]
    large = int(sum(sizes) * share / (1 - share))
    runs, loads = sharding.pack_into(histogram([*sizes, large]), 24)
    assert loads_of(runs) == dict(enumerate(loads))
    assert {size: sum(n for _, n in own) for size, own in runs} == Counter([*sizes, large])
    others = sorted(loads)[:-1]
    assert large in loads and len(others) == 23 and min(others) > 0.95 * max(others)


def test_coarse_items_leave_no_bin_empty():
    runs, loads = sharding.pack_into([(6, 40)], 24)
    assert sorted(loads) == [6] * 8 + [12] * 16 and loads_of(runs) == dict(enumerate(loads))
    assert sorted(sharding.pack_into([(5, 1), (4, 1), (100, 1)], 24)[1]) == [4, 5, 100]
    assert sharding.pack_into([], 24) == ([], [])


def test_sizes_keep_their_leading_bits(spark):
    sizes = [8, 9, 16383, 16384, 16385, 16387, 10**6, 10**9 + 1, 2**40 - 1, 3 * 10**13 + 7]
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    for n, up in df.select("n", sharding.rounded(F.col("n"))).collect():
        assert n <= up <= n + n // 2 ** (sharding.DIGITS - 1) and (up == n or n >= 1 << sharding.DIGITS)


def test_loads_of_a_table_are_those_of_best_fit_over_its_groups(spark):
    rng = random.Random(8)
    texts = ["z" * rng.randrange(0, 400) + f"{i % 700}" for i in range(1500)]
    df = spark.createDataFrame([(i % 1400, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    got = sharding.shard(df, 5).collect()
    sums, totals = defaultdict(int), Counter()
    for r in got:
        sums[r.shard] += r.size
    for t in texts:
        totals[t] += len(t) + sharding.OVERHEAD
    assert len(got) == 1500 and sorted(sums.values()) == sorted(sharding.pack_into(histogram(totals.values()), 5)[1])
    assert min(sums.values()) > 0.99 * max(sums.values())


def test_a_hot_row_gets_a_run_of_slots(spark, monkeypatch):
    monkeypatch.setattr(common, "COPIES", 50)
    monkeypatch.setattr(sharding, "PART_ROWS", 10)
    rows = [(1, "same", "a")] * 500 + [(1, "same", "b")] * 300 + [(i, f"t{i}", "c") for i in range(700)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(5)
    plain = sharding.shard(df.drop("slot")).collect()
    whole = sharding.stage(spark, df.withColumn("kind", F.col("slot")).withColumn("Shard", F.lit(-1)), "").collect()
    assert Counter((r.doc_id, r.text, r.kind) for r in whole) == Counter(rows)
    for found in (plain, whole):
        slots = defaultdict(list)
        for r in found:
            slots[r.shard].append(r.slot)
        assert len(found) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in whole if r.text == "same"}) == 1


def test_shards_of_a_table_with_a_large_group(spark):
    rng = random.Random(4)
    texts = [f"{i} " + "x" * rng.randrange(50, 150) for i in range(2000)]
    same = "y" * 1000
    n = sum(len(t) + sharding.OVERHEAD for t in texts) // 2 // (len(same) + sharding.OVERHEAD)
    df = spark.createDataFrame(list(enumerate([*texts, *[same] * n])), "doc_id long, text string")
    sizes, large = defaultdict(int), set()
    for r in sharding.shard(df).collect():
        sizes[r.shard] += r.size
        if r.doc_id >= len(texts):
            large.add(r.shard)
    assert len(large) == 1 and set(sizes) == set(range(sharding.N_SHARDS))
    others = [x for s, x in sizes.items() if s not in large]
    assert min(others) > 0.8 * max(others)
