"""Benchmark decontamination by winnowing.

A fingerprint is the least hash of each window of consecutive k-grams. Two texts that share a window of WINDOW words
share all k-grams in it and so choose the same one: no shared window goes unseen. Fingerprints of the documents are
looked up among those of the benchmark; each hit is extended to the windows around it, and these are compared with the
benchmark's windows. Items shorter than a window are one window each, looked up by their own length.

Words are runs of a-z, 0-9 and all beyond ASCII, with A-Z folded. A benchmark of at most BLOCK_BYTES of text is indexed
once and sent to every task. A larger one is joined: winnowed fingerprints of both sides meet by shuffle, each document's
hits bring along the hashes of the windows around them, and these meet the benchmark's windows. Of the benchmark only a
bitmap of fixed size is sent out, which drops most fingerprints that it can't hold before they are shuffled.

Defined cases: a null or empty text has no words, as a document (never contaminated) or an item (never found). Items that
share an id count once; an item without an id is named by an empty string.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import byte_table, checkpoint, grams, mix64, table, text_batches, words_of

WINDOW = 10
GRAM = 5
#: Windows of k-grams from which one fingerprint is kept, so that a whole window of words is seen.
SPAN = WINDOW - GRAM + 1
#: Bytes of benchmark text up to which its index is sent out whole.
BLOCK_BYTES = 4 << 20
_BITS = 20
#: Words of 64 bits in the bitmap of a benchmark that is joined, as a power of two.
_FILTER = 20
#: Parts over which the documents that share a fingerprint are dealt.
SALTS = 8

#: What stands between words.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS, HITS, ITEMS = "__words", "__hits", "__items"


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Positions of the fingerprints: those that are least in some window of SPAN hashes (all, if there are ties)."""
    if len(hashes) < SPAN:
        return np.zeros(0, np.int64)
    n = len(hashes) - SPAN + 1
    least = hashes[:n].copy()
    for i in range(1, SPAN):
        np.minimum(least, hashes[i : i + n], out=least)
    chosen = np.zeros(len(hashes), bool)
    for i in range(SPAN):
        chosen[i : i + n] |= hashes[i : i + n] == least
    return np.flatnonzero(chosen)


class Lookup:
    """A sorted set of hashes with the items of each; a bitmap answers most misses."""

    def __init__(self, hashes: np.ndarray, items: np.ndarray):
        order = np.lexsort((items, hashes))
        hashes, items = hashes[order], items[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (items[1:] != items[:-1])
        hashes, self.items = hashes[new], items[new]
        self.hashes, first = np.unique(hashes, return_index=True)
        self.bounds = np.append(first, len(hashes))
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[self.hashes >> np.uint64(64 - _BITS)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the hashes that are in the set, and where."""
        maybe = np.flatnonzero(self.bitmap[hashes >> np.uint64(64 - _BITS)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        ok = at < len(self.hashes)
        ok[ok] = self.hashes[at[ok]] == hashes[maybe[ok]]
        return maybe[ok], at[ok]


@dataclass
class Index:
    names: list[str]
    prints: Lookup
    windows: dict[int, Lookup]


def windows_at(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The same hashes as those of grams, at some positions."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[starts + i]
    return mix64(out)


def index_of(rows: list) -> Index:
    is_word = byte_table("alnum")
    prints, windows, names = [], {}, []
    for item_id, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        words = words_of(data, np.array([0, len(data)]), is_word)[0]
        if not len(words):
            continue
        item = len(names)
        names.append("" if item_id is None else str(item_id))
        k = min(WINDOW, len(words))
        hashes = grams(words, k)
        windows.setdefault(k, []).append((hashes, np.full(len(hashes), item)))
        if k == WINDOW:
            hashes = grams(words, GRAM)
            hashes = hashes[winnowed(hashes)]
            prints.append((hashes, np.full(len(hashes), item)))
    lookup = lambda found: Lookup(*(np.concatenate(x) for x in zip(*found)))
    empty = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    return Index(names, lookup(prints or empty), {k: lookup(found) for k, found in windows.items()})


def hits(index: Index, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which words are covered, and the pairs (text, item) found, for many texts whose words lie between bounds."""
    n = len(words)
    edge = np.zeros(n + 1, np.int64)
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found: set[tuple[int, int]] = set()
    for k, lookup in index.windows.items():
        if n < k:
            continue
        if k == WINDOW:
            prints = grams(words, GRAM)
            at = winnowed(prints)
            at = at[index.prints.places(prints[at])[0]]
            starts = np.unique((at[:, None] - np.arange(SPAN)).ravel())
            starts = starts[(starts >= 0) & (starts <= n - k)]
        else:
            starts = np.arange(n - k + 1)
        starts = starts[text_of[starts] == text_of[starts + k - 1]]
        hit, place = lookup.places(windows_at(words, starts, k))
        np.add.at(edge, starts[hit], 1)
        np.add.at(edge, starts[hit] + k, -1)
        for text, where in np.unique(np.stack([text_of[starts[hit]], place], axis=1), axis=0) if len(hit) else ():
            found.update((int(text), int(item)) for item in lookup.items[lookup.bounds[where] : lookup.bounds[where + 1]])
    return np.cumsum(edge[:-1]) > 0, sorted(found)


def annotate(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The carried columns (all, if none are named), WORDS and HITS (words, and those covered) and ITEMS (ids found)."""
    benchmark = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    carry = docs.columns if carry is None else carry
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("__row"), F.col("text").cast("string").alias("text"))
    if total <= block_bytes:
        index = docs.sparkSession.sparkContext.broadcast(index_of([tuple(r) for r in benchmark.filter("text <> ''").collect()]))
        return _looked_up(df, index).select("__row.*", WORDS, HITS, ITEMS)
    return _joined(df, benchmark).select("__row.*", WORDS, HITS, ITEMS)


def _looked_up(df: DataFrame, index) -> DataFrame:
    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word = byte_table("alnum")
        for batch in batches:
            counts, covered_counts, items = [], [], []
            for first, end, data, offsets in text_batches(batch, "text"):
                words, bounds = words_of(data, offsets, is_word)
                covered, found = hits(index.value, words, bounds)
                own: dict[int, set[str]] = {}
                for text, item in found:
                    own.setdefault(text, set()).add(index.value.names[item])
                before = np.concatenate([[0], np.cumsum(covered)]) if len(covered) else np.zeros(1, np.int64)
                counts += np.diff(bounds).tolist()
                covered_counts += (before[bounds[1:]] - before[bounds[:-1]]).tolist()
                items += [sorted(own.get(i, ())) for i in range(end - first)]
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(covered_counts, pa.int64()), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["__row", WORDS, HITS, ITEMS])

    added = [T.StructField(WORDS, T.LongType()), T.StructField(HITS, T.LongType()), T.StructField(ITEMS, T.ArrayType(T.StringType()))]
    return df.mapInArrow(looked_up, T.StructType([T.StructField("__row", df.schema["__row"].dataType), *added]))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, k and hash of each window of the benchmark's items, and with k 0 their fingerprints; shorter items' windows are both."""
    is_word = byte_table("alnum")
    for batch in batches:
        names, ks, hashes = [], [], []
        for first, end, data, offsets in text_batches(batch, "text"):
            words, bounds = words_of(data, offsets, is_word)
            for i in range(end - first):
                own = words[bounds[i] : bounds[i + 1]]
                if not len(own):
                    continue
                k = min(WINDOW, len(own))
                found = [(k, grams(own, k))]
                if k == WINDOW:
                    prints = grams(own, GRAM)
                    found.append((0, prints[winnowed(prints)]))
                for kind, values in found:
                    names += [batch.column(0)[first + i].as_py()] * len(values)
                    ks += [kind] * len(values)
                    hashes.append(values.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ks, pa.int32()), pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64))], names=["item", "k", "hash"])


def _hits_of(lengths: list[int], bitmap):
    def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """digest, k, print, start and window: the windows of a text around each fingerprint that the bitmap lets pass."""
        is_word, bits = byte_table("alnum"), bitmap.value

        def maybe(values: np.ndarray) -> np.ndarray:
            return np.flatnonzero((bits[values >> np.uint64(64 - _FILTER)] >> (values >> np.uint64(58 - _FILTER) & np.uint64(63))) & np.uint64(1))

        for batch in batches:
            for first, end, data, offsets in text_batches(batch, "text"):
                words, bounds = words_of(data, offsets, is_word)
                text_of = np.repeat(np.arange(end - first), np.diff(bounds))
                for k in lengths:
                    if len(words) < k:
                        continue
                    if k == WINDOW:
                        prints = grams(words, GRAM)
                        at = winnowed(prints)
                        at = at[maybe(prints[at])]
                        starts = (at[:, None] - np.arange(SPAN)).ravel()
                        keys = np.repeat(prints[at], SPAN)
                        ok = (starts >= 0) & (starts <= len(words) - k)
                        starts, keys = starts[ok], keys[ok]
                    else:
                        keys = grams(words, k)
                        starts = maybe(keys)
                        keys = keys[starts]
                    ok = text_of[starts] == text_of[starts + k - 1]
                    starts, keys = starts[ok], keys[ok]
                    rows = text_of[starts]
                    columns = [
                        batch.column(0).take(pa.array(first + rows)),
                        pa.array(np.full(len(rows), k, np.int32)),
                        pa.array(keys.view(np.int64)),
                        pa.array((starts - bounds[rows]).astype(np.int64)),
                        pa.array(windows_at(words, starts, k).view(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["digest", "k", "print", "start", "window"])

    return hits_of


def _joined(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = df.sparkSession
    names = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    found = checkpoint(names.mapInArrow(_windows, "item string, k int, hash bigint").distinct())
    windows = found.filter("k > 0").select("item", "k", F.col("hash").alias("window"))
    prints = found.filter(f"k < {WINDOW}").select(F.when(F.col("k") == 0, F.lit(WINDOW)).otherwise(F.col("k")).alias("k"), F.col("hash").alias("print")).distinct()
    lengths = sorted(r["k"] for r in windows.select("k").distinct().collect())
    # One row for each word of the bitmap, whatever the benchmark's size.
    place = F.shiftrightunsigned("print", 64 - _FILTER).alias("place")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(print, {58 - _FILTER}) & 63 as int))")
    set_ = prints.groupBy(place).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << _FILTER, np.uint64)
    bits[set_["place"].to_numpy()] = set_["bits"].to_numpy().view(np.uint64)
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    hit = df.select(digest.alias("digest"), "text").mapInArrow(_hits_of(lengths, spark.sparkContext.broadcast(bits)), "digest string, k int, print bigint, start bigint, window bigint")
    # Copies of a text have equal hits and fold; what shares a fingerprint is dealt by a salt.
    hit = hit.distinct().withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)))
    salted = lambda table: table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    hit = hit.join(salted(prints), ["k", "print", "salt"], "left_semi").select("digest", "k", "start", "window", "salt").distinct()
    matched = checkpoint(hit.join(salted(windows), ["k", "window", "salt"]).select("digest", "start", (F.col("start") + F.col("k")).alias("end"), "item"))
    items = matched.groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias(ITEMS))
    spans = matched.select("digest", "start", "end").distinct()
    reached = F.max("end").over(Window.partitionBy("digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reached, F.lit(0))))
    covered = spans.select("digest", new.alias("new")).groupBy("digest").agg(F.sum("new").alias(HITS))
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), NO_WORD), "")).cast("long")
    out = df.select("__row", digest.alias("digest"), n_words.alias(WORDS)).join(covered.join(items, "digest"), "digest", "left")
    return out.select("__row", WORDS, F.coalesce(HITS, F.lit(0)).cast("long").alias(HITS), F.coalesce(ITEMS, F.array().cast("array<string>")).alias(ITEMS))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row."""
    df = annotate(docs, benchmark, carry=["doc_id"], **options)
    ids = F.array_join(F.array_sort(ITEMS), ",")
    return df.select("doc_id", F.col(WORDS).alias("n_words"), F.col(HITS).alias("n_hit"), F.size(ITEMS).cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col(HITS) > 0).alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in which no window of the benchmark occurs."""
    return annotate(docs, table(spark, sf_dir, "benchmark")).filter(F.size(ITEMS) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
