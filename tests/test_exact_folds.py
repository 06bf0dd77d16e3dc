"""Medians through a histogram and authors folded twice, against plain loops."""

import collections
import math
import random
import statistics

import pytest

from orrerium.operators.medians import exact_medians
from orrerium.plans import metrics


@pytest.mark.parametrize("seed", range(3))
def test_medians_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    draws = [lambda: rng.choice([0.0, 1.0, 2.5]), lambda: rng.uniform(-3, 3), lambda: rng.uniform(1, 1.0001), lambda: math.exp(rng.uniform(-40, 40)) * rng.choice([1, -1]), lambda: 7.0]
    groups = {(rng.choice(["a", None]), i): [d() for _ in range(rng.randint(1, 60))] for i, d in enumerate(draws * 3)}
    cells = [(a, b, v, n) for (a, b), xs in groups.items() for v, n in collections.Counter(xs).items()]
    got = {(r.a, r.b): (r.median, r.n) for r in exact_medians(spark.createDataFrame(cells, "a string, b int, value double, n long"), ["a", "b"]).collect()}
    assert got.keys() == groups.keys()
    for key, xs in groups.items():
        assert math.isclose(got[key][0], statistics.median(xs), rel_tol=1e-12, abs_tol=1e-300) and got[key][1] == len(xs)


def test_medians_of_nothing(spark):
    assert exact_medians(spark.createDataFrame([], "a string, value double, n long"), ["a"]).count() == 0


INDEX = "dataset_id string, creators int, pubyear int, topic_id string, topic_name string, subfield_id string, subfield_name string, dataset_index_topic double, dataset_index_subfield double, total_cit_weight double, total_men_weight double, total_citations long, total_mentions long, fair_score double"
CREATORS = "dataset_id string, creator_name string, name_type string, affiliations array<string>, primary_identifier string"


def test_authors_equal_a_loop(spark):
    rng = random.Random(5)
    datasets = {f"d{i}": (rng.randint(1990, 2020), rng.choice(["t1", "t2", None]), rng.choice(["s1", None]), rng.choice([None, rng.random()]), rng.randint(0, 9)) for i in range(12)}
    index = [(d, 0, y, t, t and t + "n", s, s and s + "n", x, x, 1.0, 2.0, c, c, x) for d, (y, t, s, x, c) in datasets.items()]
    # most creators have neither identifier nor affiliation, which makes them one author
    people = [(rng.choice(list(datasets)), rng.choice(["Ann", "Bob ", "Cy", None]), rng.choice(["Personal", None]), rng.choice([None, None, None, ["B, a"], ["x", "B"]]), rng.choice([None, None, "o1"])) for _ in range(300)]
    out = metrics.author_index(spark.createDataFrame(people, CREATORS), spark.createDataFrame(index, INDEX)).collect()
    want = collections.defaultdict(list)
    for d, name, kind, places, who in people:
        name = name and name.strip()
        if name is None and who is None:
            continue
        parts = None if places is None else [p.strip() for p in ",".join(places).split(",")]
        key = who or (None if parts is None or name is None else f"{name.lower()}_[{', '.join(sorted(p.lower() for p in parts))}]")
        want[key].append((name, kind, parts or [], who, *datasets[d]))
    assert {r.distinct_group_id for r in out} == set(want) and len(out) == len(want)

    def top(values):
        counts = collections.Counter(v for v in values if v is not None)
        return min(counts, key=lambda v: (-counts[v], v)) if counts else None

    for r in out:
        rows = want[r.distinct_group_id]
        scores = [x[7] for x in rows if x[7] is not None]
        assert r.display_name == top(x[0] for x in rows) and r.name_type == top(x[1] for x in rows) and r.primary_topic_id == top(x[5] for x in rows)
        assert r.all_affiliations == sorted({p for x in rows for p in x[2]}) and r.primary_identifier == rows[0][3]
        assert (r.first_pub_year, r.last_pub_year, r.n_datasets) == (min(x[4] for x in rows), max(x[4] for x in rows), len(rows))
        assert (r.n_unique_topics, r.n_unique_subfields) == (len({x[5] for x in rows} - {None}), len({x[6] for x in rows} - {None}))
        assert r.sum_total_citations == sum(x[8] for x in rows) and math.isclose(r.total_cit_weight, len(rows))
        assert (r.avg_fair_score is None) if not scores else math.isclose(r.avg_fair_score, statistics.mean(scores)) and math.isclose(r.S_index_topics, sum(scores))
