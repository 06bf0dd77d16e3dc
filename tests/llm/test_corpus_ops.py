"""Similarity join, rules, decontamination, mixing, sharding and the pipeline against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from orrerium.llm import decontamination, mixing, ngram_join, quality_rules, sharding

BLANK = r"[\x20\x09-\x0D]+"


def blank_words(text, fold=False):
    text = text or ""
    if fold:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(BLANK, text) if w]


def brute_links(rows):
    sets = []
    for _, text, *_ in rows:
        w = blank_words(text, True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    part = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            least = min([part[i], *(part[j] for j in linked[i])])
            changed |= least != part[i]
            part[i] = least
    ids = defaultdict(list)
    for i in range(n):
        ids[part[i]].append(rows[i][0])
    return [(r[0], min((x for x in ids[part[i]] if x is not None), default=r[0]) if sets[i] else r[0], len(linked[i])) for i, r in enumerate(rows)]


def test_join_equals_brute_force(docs, rows, empty):
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(docs).collect())
    assert got == Counter(brute_links(rows))
    assert ngram_join.join(empty).count() == 0


def test_join_in_small_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "SIGN_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "TEXT_BLOCK", 3)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(df).collect()) == Counter(brute_links(rows))


def test_common_members_are_counted_by_products_and_by_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, 60) ** 2 // 300).astype(np.uint64) for _ in range(40)]
    left, right = sets[:25], sets[20:]
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    for dense, at_once in ((1, 7), (4, 1 << 18), (1000, 50)):
        monkeypatch.setattr(ngram_join, "DENSE", dense)
        monkeypatch.setattr(ngram_join, "AT_ONCE", at_once)
        assert (ngram_join.common_counts(left, right) == want).all()


def test_pruned_stars_connect_what_all_pairs_connect():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 9, (6, ngram_join.HASHES)).astype(np.uint16)
    sign = np.array([np.where(rng.random(ngram_join.HASHES) < 0.2, 100 + i, base[i % 6]) for i in range(90)], np.uint16)
    bucket = np.sort(rng.integers(0, 4, 90))
    columns = [pa.array(x) for x in (bucket, np.zeros(90, np.int64), np.zeros(90, np.int64), np.zeros(90, np.int64), np.arange(90))]
    signs = pa.array(list(sign.view(np.int64).reshape(90, -1)), pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([*columns, signs], names=["bucket", "lo", "hi", "block", "node", "sign"])
    stars = [(a, b) for out in ngram_join._pruned(iter([batch])) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
    pairs = [(a, b) for a in range(90) for b in range(a) if bucket[a] == bucket[b]]
    stay = ngram_join._staying(sign, *(np.array(x) for x in zip(*pairs)), ngram_join.least_matches())
    assert 0 < len(stay[0]) < len(pairs) and len(stars) < 90
    roots = [ngram_join._roots(90, *(np.array(x, np.int64) for x in zip(*edges))) for edges in (stars, list(zip(*stay)))]
    assert (roots[0] == roots[1]).all()


def test_pruning_bounds_rise_and_keep_true_pairs():
    least = ngram_join.least_matches()
    assert least == sorted(least) and least[-1] < 0.8 * ngram_join.HASHES


def test_one_of_each_class_stays(spark, docs, rows):
    kept = ngram_join.stage(spark, docs, "")
    assert kept.columns == docs.columns
    groups = defaultdict(list)
    for (doc_id, class_id, links), row in zip(brute_links(rows), rows):
        groups[class_id if links or blank_words(row[1]) else ("own", id(row))].append(row)
    got = Counter(r.doc_id for r in kept.collect() if blank_words(r.text))
    assert got == Counter(k for k in groups if not isinstance(k, tuple))


def brute_rules(text):
    w = blank_words(text)
    seen, covered = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if blank_words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rules_equal_brute_force(docs, empty):
    book = quality_rules.ledger(docs)
    for r in book.collect():
        want = brute_rules(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert bool(r.fail_bits & 3) == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert quality_rules.ledger(empty).count() == 0


def test_ablations_count_what_each_rule_alone_rejects(spark, docs):
    book = quality_rules.ledger(docs)
    bits = [r.fail_bits for r in book.collect()]
    names = [n for n, _ in quality_rules.RULES]
    for policy in (quality_rules.BASE, quality_rules.CURRENT):
        for r in quality_rules.ablations(book, policy).collect():
            bit, mask = 1 << names.index(r.rule), policy.mask
            assert r.n_failed == sum(bool(b & bit) for b in bits)
            assert r.n_failed_alone == sum((b & mask) == bit for b in bits)
            assert r.n_kept == sum(not b & mask for b in bits) and r.n_kept_without == sum(not b & mask & ~bit for b in bits)
    kept = quality_rules.stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == sum(not b & quality_rules.CURRENT.mask for b in bits)


def brute_hits(docs, bench):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    items = [(i, split(t)) for i, t in bench]
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = split(text), set(), set()
        for item, iw in items:
            k = min(10, len(iw))
            wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if k and tuple(w[i : i + k]) in wins:
                    hit.update(range(i, i + k))
                    found.add("" if item is None else str(item))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [16 << 20, 200])
def test_decontamination_equals_brute_force(spark, docs, rows, empty, block_bytes):
    long = rows[95][1].split()
    bench = [(1, " ".join(long[10:40])), (2, "Two, WORDS!"), (3, rows[0][1].upper()), (10, None), (11, ""), (None, " ".join(rows[1][1].split()[:10])), (2, "two words"), (12, "the the the " * 9), (13, " ".join(rows[2][1].split()[3:12])), (14, " ".join(rows[4][1].split()[3:14]))]
    bench_df = spark.createDataFrame(bench, "item_id long, text string")
    more = [*rows, (700, "the " * 500, None, None), (701, "x " + " ".join(long[15:26]) + " y", None, None), (702, "x " + " ".join(long[15:24]) + " y", None, None)]
    df = spark.createDataFrame([r[:2] for r in more], "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in decontamination.decontaminate(df, bench_df, block_bytes=block_bytes).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
    assert got == brute_hits(more, bench)
    assert decontamination.decontaminate(empty, bench_df).count() == 0
    assert {r.contaminated for r in decontamination.decontaminate(df, bench_df.limit(0)).collect()} == {False}


def filled(sizes):
    """Targets by sharing the excess of full sources again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        free = total - sum(full.values())
        share = {s: free * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        full |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("leaf_rows,fan_in", [(1 << 14, 64), (7, 2)])
def test_mix_meets_targets(docs, rows, empty, monkeypatch, leaf_rows, fan_in):
    monkeypatch.setattr(mixing, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(blank_words(text))
    want = filled(sizes)
    by_source = defaultdict(list)
    source_of = {r[0]: r[3] for r in rows}
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by_source[source_of[r.doc_id]].append(r)
    for source, own in by_source.items():
        assert all(r.source_size == sizes[source] for r in own) and own[0].target == pytest.approx(want[source])
        assert abs(sum(r.taken for r in own) - want[source]) <= max(r.size for r in own) * 3
    again = mixing.mix(docs.repartition(2)).collect()
    assert Counter(again) == Counter(got)
    assert mixing.mix(empty).count() == 0


def test_rounding_keeps_mass_and_expectation():
    rng = np.random.default_rng(0)
    units = [(f"u{i}", int(s), float(p)) for i, (s, p) in enumerate(zip(rng.integers(1, 100, 40), rng.uniform(0.05, 0.95, 40)))]
    expected = sum(s * p for _, s, p in units)
    ups = Counter()
    for level in range(400):
        done, held = mixing.pivot(units, level)
        size = {k: s for k, s, _ in units}
        mass = sum(size[k] * up for k, up in done) + (held[1] * held[2] if held else 0)
        assert mass == pytest.approx(expected) and len(done) >= 39
        ups.update({k: up for k, up in done} | ({held[0]: held[2]} if held else {}))
    assert max(abs(ups[k] / 400 - p) for k, _, p in units) < 0.12


def test_packing_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = [int(s) for s in rng.integers(1, 60, int(rng.integers(1, 80)))]
        runs, loads = sharding.pack(list(Counter(sizes).items()), 100)
        rooms, want = [], Counter()
        for size in sorted(sizes, reverse=True):
            fits = [(room, b) for b, room in enumerate(rooms) if room >= size]
            if fits:
                b = min(fits)[1]
            else:
                rooms.append(100)
                b = len(rooms) - 1
            rooms[b] -= size
            want[size, b] += 1
        assert {(size, b): n for size, own in runs for b, n in own} == want and loads == [100 - r for r in rooms]
        assert len(sharding.pack_into(list(Counter(sizes).items()), 7)[1]) <= 7


def test_shards_are_whole_and_gapless(docs, rows, empty):
    got = sharding.shard(docs, 4).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    text_of = {r[0]: r[1] for r in rows}
    where, slots = defaultdict(set), defaultdict(list)
    for r in got:
        text = text_of[r.doc_id]
        assert r.size == len((text or "").encode()) + 8 and r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
        where[text].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert sharding.shard(empty).count() == 0


def test_pipeline_stages_follow_each_other(spark, docs, rows, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = [(1, " ".join(rows[5][1].split()[:15])), (2, " ".join(rows[6][1].split()[:15]))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == (docs.columns if name != "sharding" else [*docs.columns, "shard", "slot"])
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter((r.doc_id, r.shard) for r in whole.collect()).keys() == Counter((r.doc_id, r.shard) for r in now.collect()).keys()
    got = whole.collect()
    assert 5 not in {r.doc_id for r in got}
    text_of = {r[0]: (r[1], r[2], r[3]) for r in rows}
    assert got and all((r.text, r.lang, r.source) == text_of[r.doc_id] for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "decontamination", "mixing", "sharding"]
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
    assert none.count() == 0
