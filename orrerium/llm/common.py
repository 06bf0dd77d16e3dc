"""Helpers that the training-data operators share: table access, checkpoints and ragged text batches."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every contract here counts words as runs of anything but these ASCII blanks.
BLANK = r"[ \t\n\x0B\f\r]"
#: Groups up to which a row for each of them is sent to every task.
FEW_GROUPS = 10_000
#: A key with more than one of so many parts of all rows is joined where its rows lie.
HOT_KEYS = 1000
#: Copies of a row that one task writes at most before they are dealt.
COPIES = 10_000
#: Bytes of text that a vectorised step holds at once; one longer text is a batch of its own.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that the session names. Where none is named, a local one serves a local session only."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="orrerium-checkpoint-"))
    return named or context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def held_out(doc_id: str = "doc_id"):
    """True for the rows that no model may learn from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spread_join(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of rows with facts (one row for each key, with `n`, the number of its rows), whatever share a key holds.

    Fewer than HOT_KEYS keys can hold more than total / HOT_KEYS of all rows. Their facts are sent to the rows, which stay
    where they lie; the other keys are shuffled.
    """
    hot = facts.filter(F.col("n") > max(total / HOT_KEYS, 16))
    cold = facts.filter(F.col("n") <= max(total / HOT_KEYS, 16))
    here = rows.join(F.broadcast(hot), key)
    return here.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column `times` says, numbered from 0 in `copy`; what repeats very often is dealt over tasks."""
    few = df.filter(F.col(times).between(1, COPIES)).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1)))
    many = df.filter(F.col(times) > COPIES).withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / COPIES)))).repartition("__lot")
    first = F.col("__lot") * COPIES
    many = many.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES, times) - 1))).drop("__lot")
    return few.unionByName(many)


def row_digest(df: DataFrame) -> Column:
    """A hash of all columns of a row; rows that are equal in all of them agree."""
    plain = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*plain)


def _level(sizes: dict[int, int], most: int) -> float:
    """What each group gives so that all give `most` together; sizes: number of groups of each size."""
    left, groups = float(most), sum(sizes.values())
    for size in sorted(sizes):
        if left <= size * groups:
            break
        left -= size * sizes[size]
        groups -= sizes[size]
    return left / groups if groups else float(most)


def balanced_sample(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """At most `most` rows, dealt evenly over the groups as far as they reach, by a hash of the key (distinct in a group).

    Small groups stay whole; of a larger one those rows stay whose hash is below the share that it may give. So no group is
    sorted or gathered anywhere; only a histogram of group sizes, of at most `most` rows, is read.
    """
    hashed = rows.withColumn("__h", F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) / float(1 << 40))
    sizes = checkpoint(hashed.groupBy(group).agg(F.count("*").alias("__n")))
    histogram = sizes.groupBy(F.least("__n", F.lit(most)).alias("size")).count().collect()
    level = _level({r["size"]: r["count"] for r in histogram}, most)
    sizes = sizes.withColumn("__rate", F.least(F.lit(1.0), F.lit(level) / F.col("__n"))).drop("__n")
    # Sent out whole while groups are few, so that rows are thinned where they lie and not after a shuffle by group.
    sizes = F.broadcast(sizes) if sum(r["count"] for r in histogram) <= FEW_GROUPS else sizes
    thin = hashed.join(sizes, group).filter(F.col("__h") < F.col("__rate"))
    return thin.orderBy(F.col("__h") / F.col("__rate"), key, group).limit(most).drop("__h", "__rate")


def whole_within(rows: list, size, most: int) -> list:
    """The rows, in their order, as far as their sizes add up to at most `most`; one that doesn't fit is left out whole."""
    out, total = [], 0
    for row in rows:
        if total + size(row) <= most:
            total += size(row)
            out.append(row)
    return out


def text_batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of at most BATCH_BYTES (or one row) of a text column: first row, end row, bytes, offsets from 0.

    A null text is an empty one here; callers that tell them apart look at the column's own mask.
    """
    col = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(col.type):
        width = np.int64
    else:
        col, width = col.cast(pa.string()), np.int32
    n = len(col)
    if n == 0:
        return
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, dtype=width)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if col.null_count:
        # a null may span bytes of the buffer that mean nothing
        lengths = np.where(np.asarray(col.is_null()), 0, np.diff(offsets))
        if lengths.sum() != offsets[-1] - offsets[0]:
            data = np.concatenate([data[a : a + k] for a, k in zip(offsets[:-1], lengths)] or [data[:0]])
            offsets = np.concatenate([[0], np.cumsum(lengths)])
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + BATCH_BYTES, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = np.array([base], np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * step])
        step = step * step
    return out[:n]


_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 2**64, size=256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit avalanche hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(kept: str) -> np.ndarray:
    """For each byte, 1 if it belongs to a word: 'blank' splits at ASCII blanks, 'alnum' at all ASCII but a-z and 0-9."""
    ok = np.ones(256, bool)
    if kept == "blank":
        ok[[0x20, *range(0x09, 0x0E)]] = False
    else:
        ok[:0x80] = False
        ok[ord("0") : ord("9") + 1] = True
        ok[ord("a") : ord("z") + 1] = True
        ok[ord("A") : ord("Z") + 1] = True
    return ok


FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (ASCII letters folded to lower case), in order, and each text's first word, with the end."""
    hashes, starts = placed_words(data, offsets, is_word)
    return hashes, np.searchsorted(starts, offsets)


def placed_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, in order, and the byte at which it starts.

    The work is over the bytes of many texts at once. Words hash by a polynomial over random byte values, so that
    equal words have equal hashes wherever they stand.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _POW:
        _POW.clear()
        _POW[size] = (_powers(_BASE, size), _powers(_INVERSE, size))
    power, inverse = _POW[size]
    word = is_word[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[FOLD[data]] * power[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    hashes = mix64(hashes + (ends - starts).astype(np.uint64))
    return hashes, starts


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, by the position of its first; texts must be told apart by the caller."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - k + 1 + i]
    return mix64(out)
