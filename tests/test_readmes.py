"""READMEs of last visits against a plain loop; no step makes more rows than the tables have."""

import random

import pytest

from orrerium.plans import harvests

SCHEMAS = {
    "origin": "url string", "status": "origin string, date int, snapshot string", "branch": "snapshot_id string, name binary, target string, target_type string",
    "revision": "id string, directory string", "entry": "directory_id string, name binary, target string, type string", "content": "sha1_git string, sha1 string",
}
URL = "https://github.com/u/"


def rows_made(plan) -> int:
    """The most rows that a step of an executed plan returned."""
    own = plan.metrics().get("numOutputRows")
    children = plan.children()
    return max([own.get().value() if own.isDefined() else 0, *[rows_made(children.apply(i)) for i in range(children.size())]])


def chain(spark, tables):
    # without run-time planning the plan is one tree that holds all counts
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = harvests.readme_contents(*[spark.createDataFrame(tables[k], s) for k, s in SCHEMAS.items()])
        got = sorted(tuple(r) for r in out.collect())
        return got, rows_made(out._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_visits_do_not_meet_every_branch(spark):
    """One snapshot with 400 branches, seen by 400 visits: not 160,000 rows."""
    n = range(400)
    tables = {
        "origin": [(f"{URL}{i % 40}",) for i in n], "status": [(f"{URL}{i % 40}", i, "s") for i in n], "branch": [("s", b"refs/heads/main", f"r{i}", "revision") for i in n],
        "revision": [(f"r{i}", f"d{i}") for i in n], "entry": [(f"d{i}", b"README", f"c{i}", "file") for i in n], "content": [(f"c{i}", f"x{i}") for i in n],
    }
    got, most = chain(spark, tables)
    assert got == sorted((f"{URL}{k}", 360 + k, "c99", "x99") for k in range(40))
    assert most <= 400


@pytest.mark.parametrize("seed", range(3))
def test_readmes_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    some = lambda sign, n: f"{sign}{rng.randrange(n)}"
    urls = [f"{URL}{i}" for i in range(8)] + ["https://gitlab.example/u/1"]
    tables = {
        "origin": [(rng.choice([*urls[:6], urls[8]]),) for _ in range(12)],
        "status": [(rng.choice(urls), rng.choice([None, 1, 2, 3]), rng.choice([None, some("s", 6)])) for _ in range(40)],
        "branch": [(some("s", 6), rng.choice([b"refs/heads/main", b"refs/heads/master", b"refs/heads/dev"]), some("r", 8), rng.choice(["revision", "revision", "release"])) for _ in range(20)],
        "revision": [(f"r{i}", some("d", 5)) for i in range(7)],
        "entry": [(some("d", 5), rng.choice([b"README.md", b"README", b"LICENSE"]), some("c", 12), rng.choice(["file", "file", "dir"])) for _ in range(20)],
        "content": [(f"c{i}", f"x{i}") for i in range(0, 12, 2)],
    }
    want = {}
    for (url,) in tables["origin"]:
        found = [
            (date is not None, date, blob, sha)
            for at, date, snapshot in tables["status"] if at == url and url.startswith(URL)
            for s, name, target, kind in tables["branch"] if s == snapshot and kind == "revision" and name != b"refs/heads/dev"
            for r, d in tables["revision"] if r == target
            for e, file, blob, type_ in tables["entry"] if e == d and type_ == "file" and file != b"LICENSE"
            for c, sha in tables["content"] if c == blob
        ]
        if found:
            want[url] = max(found, key=lambda x: (x[0], x[1] or 0, x[2]))[1:]
    got, _ = chain(spark, tables)
    assert got == sorted((u, *w) for u, w in want.items()) and got
