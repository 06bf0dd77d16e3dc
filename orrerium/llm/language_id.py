"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

A text is read in windows of LENGTH bytes. In each, one gated recurrent network reads forwards and one backwards; a
linear layer labels every position from both states, and a document's probabilities are those of its positions, pooled
as the softmax of their mean log-probabilities. All bytes of every text are read.

The network is fitted by backpropagation through time on every window of a bounded sample of rows: at most TRAIN_ROWS,
chosen by a hash of the id and balanced over languages, and as many of them in that order as together have TRAIN_BYTES; a
text that would go beyond is left out whole. Rows of one id are folded into one. Held-out rows are never read for it, and
neither source nor id is an input. Weights and order come from fixed seeds.

Defined cases: a text that is null or has no letter (a character that Unicode files under letters) is `und` with score 0;
with no labelled rows at all every text is `und`. Rows that repeat get equal answers. Of rows that share an id the one of
least language, then least hash of the text, is learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import balanced_sample, held_out, text_batches, whole_within

LENGTH = 64
HIDDEN = 8
#: Rows that training collects at most, and bytes of all their texts.
TRAIN_ROWS, TRAIN_BYTES = 4000, 1 << 22
#: Least number of steps; more are made where one pass over all windows takes more.
STEPS, BATCH, RATE = 260, 256, 0.02
#: Windows that are read side by side.
LANES = 2048
SEED = 7
UNKNOWN = "und"
#: Letters and some numeric signs, which `has_letter` tells from them.
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text or ""))


class Network:
    """Weights of both directions and the output layer. Gates lie as [update, reset, candidate]."""

    def __init__(self, n_labels: int, rng: np.random.Generator):
        h, f = HIDDEN, np.float32
        self.weights = {
            "x": rng.normal(0, 0.3, (2, 256, 3 * h)).astype(f),  # what each byte adds to the gates
            "u": rng.normal(0, 0.3, (2, h, 3 * h)).astype(f),
            "o": rng.normal(0, 0.3, (2 * h, n_labels)).astype(f),
            "c": np.zeros(n_labels, f),
        }

    def states(self, bytes_: np.ndarray, keep: list | None = None) -> list[np.ndarray]:
        """States (time, lane, hidden) of both directions for bytes (time, lane). keep: gets what training needs."""
        h, out = HIDDEN, []
        steps, lanes = bytes_.shape
        for way in range(2):
            x, u = self.weights["x"][way], self.weights["u"][way]
            gates_u, cand_u = np.ascontiguousarray(u[:, : 2 * h]) * np.float32(0.5), np.ascontiguousarray(u[:, 2 * h :])
            x = x.copy()
            x[:, : 2 * h] *= np.float32(0.5)  # a sigmoid is half a tanh of half its argument, and a half
            all_ = np.empty((steps, lanes, h), np.float32)
            state = np.zeros((lanes, h), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                a = x[bytes_[t]]
                g = state @ gates_u
                g += a[:, : 2 * h]
                np.tanh(g, out=g)
                g *= np.float32(0.5)
                g += np.float32(0.5)
                z, r = g[:, :h], g[:, h:]
                n = (r * state) @ cand_u
                n += a[:, 2 * h :]
                np.tanh(n, out=n)
                if keep is not None:
                    keep.append((way, t, state, z, r, n))
                state = n + z * (state - n)
                all_[t] = state
            out.append(all_)
        return out

    def log_probabilities(self, states: list[np.ndarray]) -> np.ndarray:
        """(time, lane, label)"""
        h = HIDDEN
        logits = states[0] @ self.weights["o"][:h] + states[1] @ self.weights["o"][h:] + self.weights["c"]
        logits -= logits.max(axis=-1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=-1, keepdims=True))

    def gradients(self, bytes_: np.ndarray, known: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of the mean cross-entropy over all known positions, by backpropagation through time."""
        h, w = HIDDEN, self.weights
        kept: list = []
        states = self.states(bytes_, kept)
        logp = self.log_probabilities(states)
        weight = (known / max(1, known.sum())).astype(np.float32)
        loss = -float((np.take_along_axis(logp, labels[None, :, None], 2)[..., 0] * weight).sum())
        d = np.exp(logp)
        np.put_along_axis(d, np.broadcast_to(labels[None, :, None], (len(d), len(labels), 1)), np.take_along_axis(d, np.broadcast_to(labels[None, :, None], (len(d), len(labels), 1)), 2) - 1, 2)
        d *= weight[..., None]
        flat = d.reshape(-1, d.shape[-1])
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["c"] = flat.sum(0)
        grads["o"][:h] = states[0].reshape(-1, h).T @ flat
        grads["o"][h:] = states[1].reshape(-1, h).T @ flat
        carried = [None, None]
        for way, t, before, z, r, n in reversed(kept):
            ds = d[t] @ w["o"][way * h : (way + 1) * h].T
            if carried[way] is not None:
                ds += carried[way]
            u = w["u"][way]
            dn = ds * (1 - z) * (1 - n * n)
            dz = ds * (before - n) * z * (1 - z)
            back = dn @ u[:, 2 * h :].T
            dr = back * before * r * (1 - r)
            gates = np.concatenate([dz, dr], axis=1)
            carried[way] = ds * z + back * r + gates @ u[:, : 2 * h].T
            grads["u"][way][:, : 2 * h] += before.T @ gates
            grads["u"][way][:, 2 * h :] += (r * before).T @ dn
            np.add.at(grads["x"][way], bytes_[t], np.concatenate([gates, dn], axis=1))
        return loss, grads


def fit(windows: np.ndarray, known: np.ndarray, labels: np.ndarray, n_labels: int) -> Network:
    """windows: bytes (row, LENGTH); known: which of them are text; labels: of each row. Adam with a falling rate."""
    rng = np.random.default_rng(SEED)
    net = Network(n_labels, rng)
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    steps = max(STEPS, -(-len(windows) // BATCH))
    # Pass after pass over all windows, each in an order of its own.
    order = np.concatenate([rng.permutation(len(windows)) for _ in range(-(-steps * BATCH // len(windows)))])
    for step in range(1, steps + 1):
        rows = order[(step - 1) * BATCH : step * BATCH]
        _, grads = net.gradients(windows[rows].T, known[rows].T, labels[rows])
        rate = RATE * (1 - (step - 1) / steps) + 1e-3
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            net.weights[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame) -> tuple[Network | None, list[str]]:
    """The network and its labels, from a bounded sample of the labelled rows that aren't held out."""
    rows = docs.filter(~held_out()).filter("lang is not null and text <> '' and doc_id is not null")
    rows = rows.select("lang", "doc_id", F.xxhash64("text").alias("sig"), F.octet_length("text").cast("long").alias("size"))
    # Sizes and hashes choose the rows, so that only chosen texts are moved.
    known = rows.groupBy("doc_id").agg(F.min(F.struct("lang", "sig", "size")).alias("r")).select("doc_id", "r.*")
    chosen = whole_within(balanced_sample(known, "lang", "doc_id", TRAIN_ROWS).collect(), lambda r: r["size"], TRAIN_BYTES)
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["sig"], n) for n, r in enumerate(chosen)], T.StructType([docs.schema["doc_id"], T.StructField("sig", T.LongType()), T.StructField("n", T.IntegerType())]))
    texts = docs.select("doc_id", F.xxhash64("text").alias("sig"), "text").join(F.broadcast(ids), ["doc_id", "sig"])
    found = texts.groupBy("n").agg(F.first("text").alias("text")).collect()
    return sample_fit([(chosen[r["n"]]["lang"], r["text"]) for r in sorted(found)])


def sample_fit(sample: list[tuple[str, str]]) -> tuple[Network | None, list[str]]:
    """Fits on all windows of the texts, the last of each filled up with bytes that count for nothing."""
    langs = sorted({lang for lang, _ in sample})
    windows, known, labels = [], [], []
    for lang, text in sample:
        data = np.frombuffer(text.encode(), np.uint8)
        n = -(-len(data) // LENGTH)
        windows.append(np.pad(data, (0, n * LENGTH - len(data))).reshape(n, LENGTH))
        known.append((np.arange(n * LENGTH) < len(data)).reshape(n, LENGTH))
        labels.append(np.full(n, langs.index(lang)))
    if not sum(map(len, windows)):
        return None, []
    return fit(np.concatenate(windows), np.concatenate(known), np.concatenate(labels), len(langs)), langs


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of log-probabilities over the positions of each text (text, label)."""
    n_labels = len(net.weights["c"])
    sizes = np.diff(offsets)
    per = -(-sizes // LENGTH)
    text_of = np.repeat(np.arange(len(sizes)), per)
    first = np.cumsum(per) - per
    start = offsets[:-1][text_of] + (np.arange(len(text_of)) - first[text_of]) * LENGTH
    size = np.minimum(offsets[1:][text_of] - start, LENGTH)
    out = np.zeros((len(sizes), n_labels))
    padded = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
    steps = np.arange(LENGTH)[:, None]
    for at in range(0, len(start), LANES):
        lanes = slice(at, at + LANES)
        known = steps < size[lanes][None, :]
        bytes_ = np.where(known, padded[start[lanes][None, :] + steps], 0)
        logp = net.log_probabilities(net.states(bytes_))
        logp *= known[..., None]
        np.add.at(out, text_of[lanes], logp.sum(axis=0))
    return out


def predict(docs: DataFrame, net: Network | None, langs: list[str]) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row."""
    model = docs.sparkSession.sparkContext.broadcast((net, langs))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, langs = model.value
        for batch in batches:
            names, scores = [], []
            texts = batch.column(2)
            for first, end, data, offsets in text_batches(batch, "text"):
                sums = pooled(net, data, offsets) if net else np.zeros((end - first, 0))
                sizes = np.diff(offsets)
                for i in range(end - first):
                    text = texts[first + i].as_py()
                    if net is None or not has_letter(text):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    mean = sums[i] / sizes[i]
                    p = np.exp(mean - mean.max())
                    p /= p.sum()
                    names.append(langs[int(p.argmax())])
                    scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predicted, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    return predict(docs, *train(docs))
