"""A quality classifier by attention-based multiple-instance learning, in numpy.

A text is a bag of passages of PASSAGE bytes. Each passage is described by how its bytes fall into classes and follow
each other, by which words it holds (dealt by a hash to N_WORDS places), and by how its words and windows of words repeat
within the text; a tanh layer encodes that description. A gated attention weighs the passages, learned from labels of
whole documents only, and a logistic layer scores the weighted mean of their codes. All passages of every text are
encoded, in training and in scoring.

The model is fitted on a bounded sample: at most TRAIN_ROWS labelled documents that aren't held out, half of each label as
far as there are so many, chosen by a hash of the id, and as many of them in that order as together have TRAIN_PASSAGES
passages; a document that would go beyond is left out whole. Labels, language, source and id are never inputs of a score.

Defined cases: a null or empty text is one passage without a byte, learned and scored like others; if no label or only one
is known, every text scores that label's share (0.5 without labels). A document with several labels counts with the least,
and of documents that share an id the one of least hash of the text is learned from. Rows that repeat get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import balanced_sample, byte_table, grams, held_out, placed_words, text_batches, whole_within

PASSAGE = 512
TRAIN_ROWS, TRAIN_PASSAGES = 4000, 1 << 15
CODE, GATE = 16, 8
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4
ACCEPT = 0.7
SEED = 11


def _classes() -> np.ndarray:
    """The class of each byte: a-z, A-Z, digits, blanks, line ends, five kinds of signs, control bytes, beyond ASCII."""
    out = np.full(256, 11, np.int64)
    out[:0x20] = 10
    for n, signs in enumerate((b".,;:", b"!?", b"'\"()-_", b"#*$%&|<>", b"@+=/\\[]{}^~`")):
        out[list(signs)] = 5 + n
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[[0x20, 0x09]] = 3
    out[[0x0A, 0x0D]] = 4
    return out


KIND = _classes()
N_KINDS = 12
N_REPEATS = 4
N_WORDS = 128
#: Shares of classes, of pairs of classes, of hashed words and of repetitions, and whether the text is empty.
WIDTH = N_KINDS + N_KINDS * N_KINDS + N_WORDS + N_REPEATS + 1


def _again(values: np.ndarray, bag: np.ndarray) -> np.ndarray:
    """True where a value stood before in the same bag (bags are numbered in order)."""
    if not len(values):
        return np.zeros(0, bool)
    order = np.lexsort((np.arange(len(values)), values, bag))
    same = (values[order][1:] == values[order][:-1]) & (bag[order][1:] == bag[order][:-1])
    out = np.zeros(len(values), bool)
    out[order[1:]] = same
    return out


def described(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions of all passages of many texts (passage, WIDTH), and the first passage of each text, with the end."""
    sizes = np.diff(offsets)
    per = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    n = int(first[-1])
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    place = first[:-1][text_of] + (np.arange(len(data)) - offsets[:-1][text_of]) // PASSAGE
    kind = KIND[data]
    length = np.maximum(1, np.bincount(place, minlength=n))[:, None]
    single = np.bincount(place * N_KINDS + kind, minlength=n * N_KINDS).reshape(n, -1)
    follows = (place[:-1] * N_KINDS + kind[:-1]) * N_KINDS + kind[1:]
    double = np.bincount(follows[place[1:] == place[:-1]], minlength=n * N_KINDS * N_KINDS).reshape(n, -1)
    words, starts = placed_words(data, offsets, byte_table("blank"))
    bag, at = text_of[starts], place[starts]  # a word belongs to the passage in which it starts
    count = np.maximum(1, np.bincount(at, minlength=n))
    held = np.bincount(at * N_WORDS + (words % np.uint64(N_WORDS)).astype(np.int64), minlength=n * N_WORDS).reshape(n, -1)
    share = lambda flags: np.bincount(at[: len(flags)], weights=flags, minlength=n) / count
    next_same = np.append((words[1:] == words[:-1]) & (bag[1:] == bag[:-1]), False)[: len(words)]
    windows = []
    for k in (3, 8):
        hashes = grams(words, k)
        inside = bag[: len(hashes)] == bag[len(words) - len(hashes) :]
        windows.append(share(_again(hashes, bag[: len(hashes)]) & inside))
    repeats = np.stack([share(next_same), share(_again(words, at)), *windows, np.zeros(n)], axis=1)
    repeats[first[:-1], -1] = sizes == 0
    return np.concatenate([single / length, double / length, held / count[:, None], repeats], axis=1).astype(np.float32), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Model:
    """Weights of the encoder, the gated attention and the score, and the scaling of descriptions."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng, f = np.random.default_rng(SEED), np.float32
        self.mean, self.spread = mean.astype(f), spread.astype(f)
        self.w = {
            "e": rng.normal(0, WIDTH**-0.5, (WIDTH, CODE)).astype(f), "eb": np.zeros(CODE, f),
            "v": rng.normal(0, 0.3, (CODE, GATE)).astype(f), "u": rng.normal(0, 0.3, (CODE, GATE)).astype(f), "a": rng.normal(0, 0.3, GATE).astype(f),
            "s": rng.normal(0, 0.3, CODE).astype(f), "sb": np.zeros(1, f),
        }

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -6, 6)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        """x: scaled descriptions of bags, none empty, that begin at starts."""
        w = self.w
        h = np.tanh(x @ w["e"] + w["eb"])
        v, u = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        logits = (v * u) @ w["a"]
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        e = np.exp(logits - np.maximum.reduceat(logits, starts)[bag])
        alpha = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
        return {"h": h, "v": v, "u": u, "alpha": alpha, "bag": bag, "z": z, "p": _sigmoid(z @ w["s"] + w["sb"][0])}

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over the bags, and its gradients."""
        w, f = self.w, self.forward(x, starts)
        h, v, u, alpha, bag, z, p = (f[k] for k in ("h", "v", "u", "alpha", "bag", "z", "p"))
        loss = -float(np.mean(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9)))
        d = (p - y) / len(y)
        g = {"s": z.T @ d, "sb": np.array([d.sum()])}
        dz = d[:, None] * w["s"]
        dalpha = (dz[bag] * h).sum(1)
        mean = np.add.reduceat(alpha * dalpha, starts)
        dlogits = alpha * (dalpha - mean[bag])
        g["a"] = (v * u).T @ dlogits
        dvu = dlogits[:, None] * w["a"]
        dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
        g["v"], g["u"] = h.T @ dv, h.T @ du
        dh = (alpha[:, None] * dz[bag] + dv @ w["v"].T + du @ w["u"].T) * (1 - h * h)
        g["e"], g["eb"] = x.T @ dh, dh.sum(0)
        return loss, g


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """bags: descriptions of each document's passages. Adam, with documents in an order from a fixed seed."""
    whole = np.concatenate(bags)
    model = Model(whole.mean(0), np.maximum(whole.std(0), 1e-3))
    bags = [model.scaled(b) for b in bags]
    rng = np.random.default_rng(SEED + 1)
    mean = {k: np.zeros_like(x) for k, x in model.w.items()}
    square = {k: np.zeros_like(x) for k, x in model.w.items()}
    step, total = 0, EPOCHS * -(-len(bags) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])[:-1]])
            _, g = model.gradients(np.concatenate([bags[i] for i in own]), starts, labels[own])
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k in g:
                grad = g[k] + DECAY * model.w[k]
                mean[k] = 0.9 * mean[k] + 0.1 * grad
                square[k] = 0.999 * square[k] + 0.001 * grad * grad
                model.w[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n and the descriptions of all passages of the text, as half-precision numbers."""
    for batch in batches:
        out = []
        for first, end, data, offsets in text_batches(batch, "text"):
            x, bounds = described(data, offsets)
            out += [x[bounds[i] : bounds[i + 1]].astype(np.float16).tobytes() for i in range(end - first)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["n", "x"])


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or the share of label 1 where there is nothing to tell apart."""
    known = labels.filter(~held_out()).filter("quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("quality"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.filter(~held_out()).filter("doc_id is not null").select("doc_id", F.xxhash64(text).alias("sig"), F.octet_length(text).cast("long").alias("size"))
    # Sizes and hashes choose the rows, so that only chosen texts are described.
    known = rows.groupBy("doc_id").agg(F.min(F.struct("sig", "size")).alias("r")).join(known, "doc_id").select("doc_id", "quality", "r.*")
    chosen = balanced_sample(known, "quality", "doc_id", TRAIN_ROWS).collect()
    chosen = whole_within(chosen, lambda r: max(1, -(-r["size"] // PASSAGE)), TRAIN_PASSAGES)
    y = np.array([r["quality"] for r in chosen], np.float32)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    schema = T.StructType([docs.schema["doc_id"], T.StructField("sig", T.LongType()), T.StructField("n", T.IntegerType())])
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["sig"], n) for n, r in enumerate(chosen)], schema)
    texts = docs.select("doc_id", F.xxhash64(text).alias("sig"), text.alias("text")).join(F.broadcast(ids), ["doc_id", "sig"]).select("n", "text")
    found = texts.mapInArrow(_described, "n int, x binary").groupBy("n").agg(F.first("x").alias("x"))
    bags: list = [None] * len(chosen)
    for r in found.collect():
        bags[r["n"]] = np.frombuffer(r["x"], np.float16).astype(np.float32).reshape(-1, WIDTH)
    return fit(bags, y)


def scores(model: Model | float, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if not isinstance(model, Model):
        return np.full(len(offsets) - 1, model)
    x, bounds = described(data, offsets)
    return model.forward(model.scaled(x), bounds[:-1])["p"].astype(np.float64)


def predict(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scores(sent.value, data, offsets) for _, _, data, offsets in text_batches(batch, "text")]
            score = np.clip(np.concatenate(found), 0, 1) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predicted, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return predict(docs, train(docs, labels.select("doc_id", "quality")))
