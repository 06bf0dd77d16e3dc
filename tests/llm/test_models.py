"""Held-out accuracy, gradients and odd inputs of the trained models."""

import random
import zlib

import numpy as np
import pytest

from orrerium.llm import language_id, quality_model

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "ren"], "bb": ["sch", "ung", "ber", "ich", "öl"], "cc": ["eau", "oi", "ment", "çe", "que"]}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(4)
    rows = [(i, text_of(rng, lang := rng.choice("aa bb cc".split()), rng.randrange(3, 60)), lang) for i in range(500)]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "123 !?", "bb"), (903, text_of(rng, "bb", 40_000), "bb"), (None, text_of(rng, "aa", 30), None), rows[0], rows[0]]
    return rows, spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").repartition(3)


def test_language_on_held_out_rows(spoken):
    rows, df = spoken
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    truth = {r[0]: r[2] for r in rows}
    own = [i for i in truth if held(i)]
    assert all(got[i].held_out == held(i) for i in truth)
    assert np.mean([got[i].lang_pred == truth[i] for i in own]) > 0.95
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"] and got[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_never_learns_from_held_out_rows(spark, spoken):
    rows, df = spoken
    lied = spark.createDataFrame([(i, t, "zz" if held(i) else lang) for i, t, lang in rows], df.schema)
    assert "zz" not in {r.lang_pred for r in language_id.identify(lied).collect()}
    unknown = spark.createDataFrame([(1, "abc", None)], df.schema)
    assert [r.lang_pred for r in language_id.identify(unknown).collect()] == ["und"]
    assert language_id.identify(df.limit(0)).count() == 0


def test_language_gradients_are_slopes():
    rng = np.random.default_rng(0)
    net = language_id.Network(3, rng)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    bytes_, known, labels = rng.integers(97, 103, (7, 4)).astype(np.uint8), np.ones((7, 4), bool), np.array([0, 1, 2, 1])
    known[5:, 1] = False
    _, grads = net.gradients(bytes_, known, labels)
    for k, at in (("u", (0, 2, 5)), ("u", (1, 3, 20)), ("x", (0, 99, 4)), ("x", (1, 100, 17)), ("o", (3, 1)), ("c", (2,))):
        keep, step = net.weights[k][at], 1e-2
        values = []
        for d in (step, -step):
            net.weights[k][at] = keep + d
            values.append(net.gradients(bytes_, known, labels)[0])
        net.weights[k][at] = keep
        assert grads[k][at] == pytest.approx((values[0] - values[1]) / (2 * step), rel=0.05, abs=2e-4)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        text = text_of(rng, "aa", rng.randrange(5, 200))
        if not good:
            text = text.replace(" ", "%%% ") if i % 2 else " ".join(w for w in text.split() for _ in range(6))
        rows.append((i, text))
        labels.append((i, int(good)))
    odd = [(900, None), (901, ""), (902, text_of(rng, "bb", 30_000)), (None, "x"), rows[0], rows[0]]
    return rows, dict(labels), spark.createDataFrame(rows + odd, "doc_id long, text string").repartition(3), spark.createDataFrame([*labels, (0, None), (None, 1), labels[1]], "doc_id long, quality int")


def test_quality_on_held_out_rows(judged):
    rows, labels, docs, table = judged
    got = {r.doc_id: r for r in quality_model.classify(docs, table).collect()}
    own = [i for i in labels if held(i)]
    assert np.mean([got[i].predicted == labels[i] for i in own]) > 0.95
    assert got[900].score == got[901].score and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert quality_model.classify(docs.limit(0), table).count() == 0


def test_quality_without_labels(judged):
    _, _, docs, table = judged
    assert {r.score for r in quality_model.classify(docs, table.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality_model.classify(docs, table.filter("quality = 1")).collect()} == {1.0}


def test_quality_gradients_are_slopes():
    rng = np.random.default_rng(0)
    model = quality_model.Model(np.zeros(quality_model.WIDTH), np.ones(quality_model.WIDTH))
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, starts, y = rng.normal(size=(9, quality_model.WIDTH)), np.array([0, 2, 3, 7]), np.array([0, 1, 1, 0])
    _, grads = model.gradients(x, starts, y)
    for k in model.w:
        at = tuple(n // 2 for n in model.w[k].shape)
        keep, values = model.w[k][at], []
        for d in (1e-5, -1e-5):
            model.w[k][at] = keep + d
            values.append(model.gradients(x, starts, y)[0])
        model.w[k][at] = keep
        assert grads[k][at] == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-4, abs=1e-8)


def test_long_labelled_texts_and_empty_ones_are_learned(spark):
    """Bad evidence stands in one passage of a long text; empty texts are bad."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        words = text_of(rng, "aa", rng.randrange(300, 900)).split()
        good = rng.random() < 0.5
        if not good:
            at = rng.randrange(len(words))
            words[at:at] = ["%%% ###"] * 40
        rows.append((i, "" if not good and i % 5 == 0 else " ".join(words)))
        labels.append((i, int(good)))
    got = quality_model.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in got if r.held_out]) > 0.95
    assert all(r.score < 0.5 for r in got if not rows[r.doc_id][1])


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def test_quality_score_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    model = quality_model.Model(rng.normal(size=quality_model.WIDTH) * 0.01, rng.uniform(0.5, 1, quality_model.WIDTH))
    texts = [text_of(random.Random(n), "cc", 5 + 90 * n) for n in range(5)] + [""]
    w = model.w
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        x, _ = quality_model.described(data, np.array([0, len(data)]))
        codes, logits = [], []
        for passage in x:
            scaled = [min(6, max(-6, (v - m) / s)) for v, m, s in zip(passage, model.mean, model.spread)]
            code = [np.tanh(sum(scaled[i] * w["e"][i, j] for i in range(quality_model.WIDTH)) + w["eb"][j]) for j in range(quality_model.CODE)]
            gate = [np.tanh(sum(code[i] * w["v"][i, j] for i in range(len(code)))) * sigmoid(sum(code[i] * w["u"][i, j] for i in range(len(code)))) for j in range(quality_model.GATE)]
            codes.append(code)
            logits.append(sum(g * a for g, a in zip(gate, w["a"])))
        alpha = np.exp(logits) / np.sum(np.exp(logits))
        z = [sum(a * c[j] for a, c in zip(alpha, codes)) for j in range(quality_model.CODE)]
        want = sigmoid(sum(a * b for a, b in zip(z, w["s"])) + w["sb"][0])
        assert quality_model.scores(model, data, np.array([0, len(data)]))[0] == pytest.approx(want, abs=1e-4)


def test_descriptions_equal_a_plain_count():
    texts = ["a b a b a", "", "x" * 1300, "one two " * 200, "é ! #\n9"]
    data = [t.encode() for t in texts]
    x, bounds = quality_model.described(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert list(np.diff(bounds)) == [max(1, -(-len(d) // quality_model.PASSAGE)) for d in data]
    n = quality_model.N_KINDS
    for d, at, end in zip(data, bounds[:-1], bounds[1:]):
        for k, row in enumerate(x[at:end]):
            part = d[k * quality_model.PASSAGE : (k + 1) * quality_model.PASSAGE]
            kinds = [quality_model.KIND[b] for b in part]
            assert row[:n] == pytest.approx([kinds.count(i) / max(1, len(part)) for i in range(n)], abs=1e-6)
            pairs = list(zip(kinds, kinds[1:]))
            assert row[n : n + n * n] == pytest.approx([pairs.count((i, j)) / max(1, len(part)) for i in range(n) for j in range(n)], abs=1e-6)
            assert row[-1] == (not d)


def test_language_scores_equal_a_plain_loop():
    rng = np.random.default_rng(2)
    net = language_id.Network(3, rng)
    h, w = language_id.HIDDEN, net.weights
    for text in (b"a", b"abc de", bytes(range(97, 117)) * 5):
        total = np.zeros(3)
        for at in range(0, len(text), language_id.LENGTH):
            part = text[at : at + language_id.LENGTH]
            padded = part + bytes(language_id.LENGTH - len(part))
            both = []
            for way in range(2):
                state, out = np.zeros(h), {}
                for t in range(len(padded)) if way == 0 else range(len(padded) - 1, -1, -1):
                    x = w["x"][way][padded[t]]
                    z = sigmoid(x[:h] + state @ w["u"][way][:, :h])
                    r = sigmoid(x[h : 2 * h] + state @ w["u"][way][:, h : 2 * h])
                    new = np.tanh(x[2 * h :] + (r * state) @ w["u"][way][:, 2 * h :])
                    state = (1 - z) * new + z * state
                    out[t] = state
                both.append(out)
            for t in range(len(part)):
                logits = both[0][t] @ w["o"][:h] + both[1][t] @ w["o"][h:] + w["c"]
                total += logits - np.log(np.exp(logits).sum())
        got = language_id.pooled(net, np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert got == pytest.approx(total, rel=1e-3)


def test_numeric_signs_are_no_letters():
    assert [language_id.has_letter(t) for t in (None, "", "12 ½ ² ① ٣ !_", "½a", "①ß", "한", "ª")] == [False, False, False, True, True, True, True]


def test_sample_is_balanced_and_bounded(spark):
    from orrerium.llm.common import balanced_sample, whole_within

    rows = spark.createDataFrame([(i, "a" if i < 5000 else "b" if i < 5400 else f"c{i % 3}") for i in range(5430)], "id long, g string").repartition(7)
    got = [(r.id, r.g) for r in balanced_sample(rows, "g", "id", 1000).collect()]
    assert got == [(r.id, r.g) for r in balanced_sample(rows.repartition(2), "g", "id", 1000).collect()]
    counts = {g: sum(r[1] == g for r in got) for g in ("a", "b", "c0")}
    assert 900 < len(got) <= 1000 and 380 < counts["b"] <= 400 and 8 <= counts["c0"] <= 10 and 470 < counts["a"] < 640, counts
    assert balanced_sample(rows.limit(0), "g", "id", 10).count() == 0
    assert whole_within([5, 9, 3, 2, 1], lambda x: x, 11) == [5, 3, 2, 1]
