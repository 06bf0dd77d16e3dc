"""No row is lost in the mix, and rows that repeat come near their source's target."""

from collections import Counter, defaultdict

import pytest

from orrerium.llm import common, mixing

SCHEMA = "doc_id string, text string, source string"


def taken(spark, rows):
    return mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()


def test_a_null_id_is_not_the_id_none(spark):
    rows = [(None, "a b c", "s0"), ("None", "a b c", "s0"), *[(f"d{i}", "a b c d", f"s{i % 3}") for i in range(300)]]
    got = taken(spark, rows)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    kept = mixing.stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert Counter(r.doc_id for r in kept.collect()) == Counter({r.doc_id: r.taken // r.size for r in got if r.taken})


def test_repeated_rows_come_near_the_target(spark, monkeypatch):
    monkeypatch.setattr(common, "COPIES", 64)  # and are written by several tasks
    rows = [("same", "a b c d e f g h i j", "s0")] * 1000 + [(f"d{i}", "x y z u v w p q r s", "s1") for i in range(1000)]
    got = taken(spark, rows)
    assert len(got) == 2000
    sums, target = defaultdict(int), {}
    for r in got:
        source = "s0" if r.doc_id == "same" else "s1"
        sums[source] += r.taken
        target[source] = r.target
        assert r.taken <= 30
    assert target["s0"] == pytest.approx(100_000 / 7) and all(abs(sums[s] - target[s]) <= 10 for s in sums)
    kept = mixing.stage(spark, spark.createDataFrame([(*r, n % 7) for n, r in enumerate(rows)], f"{SCHEMA}, kind int"), "")
    counts = Counter("same" if r.doc_id == "same" else "other" for r in kept.collect())
    assert counts == {"same": sums["s0"] // 10, "other": sums["s1"] // 10}


def test_many_sources_fill_up_as_a_plain_loop_says(spark):
    sizes = {(f"h{i:03}" if i else None): (i * 37) % 101 + (5000 if i == 9 else 0) for i in range(200)}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        share = {s: (total - sum(full.values())) * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            break
        full |= {s: 3.0 * sizes[s] for s in over}
    assert got == pytest.approx({**share, **full})
