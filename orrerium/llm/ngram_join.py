"""Near-duplicate documents: a Jaccard self-join on word shingles with Bayesian pruning of candidates.

1. Equal texts fold into one node. Each node gets MinHash values of its shingles (five words, ASCII letters folded).
2. Nodes that agree on all rows of a band are candidates. Within a bucket, pairs are compared a few MinHash values at a
   time, in blocks; a pair is dropped as soon as the posterior probability that its similarity reaches the threshold,
   given the matches so far and a uniform prior, is below a tolerance. A bucket hands on a spanning star of the pairs
   that remain, never the pairs themselves.
3. The nodes that those stars connect are verified exactly, block against block, by counting common shingles. Links are
   counted per node where they are found, and again only spanning stars are handed on.

The number of links is that of other documents (copies included) whose similarity is at least the threshold; a class is
a connected component of links, named by its least doc_id. A bucket or class of any size is dealt over tasks by blocks of
a bounded number of nodes, and of bytes where texts are long. Bands miss a pair at the threshold with a probability of (1 - 0.8**4)**32, about 5e-8.

Defined cases: a text of fewer than five words is one shingle; a text without words (null, empty, blank) has no links and
is a class of its own, as is its doc_id. Rows that repeat count as copies. Null ids sort last when a class is named.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, byte_table, checkpoint, grams, spread_join, text_batches, words_of
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
STEP = 16
TOLERANCE = 1e-9
#: Nodes in a block of MinHash values; and of whole texts, where a text of over TEXT_SHARE bytes counts as several. A row
#: is written once for each block of its group, so that large blocks save disk; a task holds two, of some 8 MB of text each.
SIGN_BLOCK, TEXT_BLOCK, TEXT_SHARE = 4096, 2048, 1 << 12
#: A shingle that more than one of so many texts have counts by a matrix product, others pair by pair.
DENSE = 16
#: Pairs that a task compares at once.
AT_ONCE = 1 << 18

_R = np.random.default_rng(5)
_XOR = _R.integers(0, 2**32, size=HASHES, dtype=np.uint32)
_MUL = _R.integers(0, 2**32, size=HASHES, dtype=np.uint32) | np.uint32(1)


def least_matches(step: int = STEP, hashes: int = HASHES, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After each step, the fewest matches with which a pair stays.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its mass above t is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(step, hashes + 1, step):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return np.unique(grams(words, min(SHINGLE, len(words)))) if len(words) else words


def signature(sets: np.ndarray) -> np.ndarray:
    """16 bits of each of HASHES MinHash values."""
    h = (sets >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 1024):
        np.minimum(low, ((h[at : at + 1024, None] ^ _XOR) * _MUL).min(axis=0), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _row_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    is_word = byte_table("blank")
    for batch in batches:
        kept, signs = [], []
        for first, end, data, offsets in text_batches(batch, "text"):
            words, starts = words_of(data, offsets, is_word)
            for row in range(first, end):
                own = words[starts[row - first] : starts[row - first + 1]]
                if len(own):
                    kept.append(row)
                    signs.append(signature(shingles(own)).view(np.int64))
        flat = pa.array(np.concatenate(signs) if signs else np.zeros(0, np.int64))
        sign = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat)
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), batch.column(3).take(rows), sign], names=["digest", "doc_id", "weight", "sign"])


def nodes_of(docs: DataFrame) -> DataFrame:
    """One row for each distinct text with a word: node, digest, doc_id (its least), copies, weight (shares of a block), sign."""
    weight = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / TEXT_SHARE)).cast("long")
    rows = docs.select(_row_key("text").alias("digest"), "doc_id", "text", weight.alias("weight"))
    signed = rows.mapInArrow(_signed, f"digest binary, doc_id {docs.schema['doc_id'].dataType.simpleString()}, weight bigint, sign array<bigint>")
    folded = signed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("weight").alias("weight"), F.first("sign").alias("sign"))
    return checkpoint(folded.withColumn("node", F.monotonically_increasing_id()))


def _dealt(df: DataFrame, size: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks (lo, hi) of its group that holds its own block."""
    df = df.withColumn("n_blocks", F.ceil(F.col(size) / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    return df.withColumn("other", F.explode(F.expr("sequence(0, n_blocks - 1)"))).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other", "n_blocks")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index that each of n indices is connected with by pairs (a, b)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the bounds of each; rows come sorted by the first `keys` columns."""
    rest: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for i in range(keys):
            col = table.column(i).to_numpy()
            change[1:] |= col[1:] != col[:-1]
        return np.append(np.flatnonzero(change), table.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and all(rest[-1].column(i)[rest[-1].num_rows - 1].equals(batch.column(i)[batch.num_rows - 1]) for i in range(keys)):
            rest.append(batch)
            continue
        table = pa.Table.from_batches([*rest, batch])
        bounds = cut(table)
        rest = [x for x in table.slice(bounds[-2]).to_batches() if x.num_rows]
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
    if rest:
        table = pa.Table.from_batches(rest)
        yield table, cut(table)


def _pairs(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within the groups that bounds cut, some at a time."""
    end = np.repeat(bounds[1:], np.diff(bounds))
    more = end - np.arange(bounds[0], bounds[-1]) - 1
    total = np.concatenate([[0], np.cumsum(more)])
    at = 0
    while at < len(more):
        to = max(at + 1, int(np.searchsorted(total, total[at] + AT_ONCE, side="right")) - 1)
        a = np.repeat(np.arange(at, to), more[at:to])
        if len(a):
            yield a + bounds[0], a + bounds[0] + 1 + np.arange(len(a)) - np.repeat(total[at:to] - total[at], more[at:to])
        at = to


def _staying(sign: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (a, b) that no step of the comparison drops."""
    matches = np.zeros(len(a), np.int64)
    for k, m in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (sign[a, part] == sign[b, part]).sum(axis=1)
        ok = matches >= m
        a, b, matches = a[ok], b[ok], matches[ok]
    return a, b


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning stars (a, b) of the pairs that stay. Columns: bucket, lo, hi, block, node, sign.

    Each group's first node, its least, meets all others, so that the stars of groups that overlap mostly share their centre.
    After that, a pair that pairs before it connect already is not compared, since it cannot change what the star spans.
    """
    least = least_matches()
    for table, bounds in _groups(batches, 3):
        lo, hi, block, node = (table.column(i).to_numpy() for i in range(1, 5))
        sign = table.column(5).combine_chunks()
        sign = (sign.chunk(0) if isinstance(sign, pa.ChunkedArray) else sign).flatten().to_numpy().view(np.uint16).reshape(-1, HASHES)
        centre = np.repeat(bounds[:-1], np.diff(bounds))
        others = np.flatnonzero(centre != np.arange(len(node)))
        root = np.arange(len(node))
        for at in range(0, len(others), AT_ONCE):
            a, b = _staying(sign, centre[others[at : at + AT_ONCE]], others[at : at + AT_ONCE], least)
            root[b] = a
        # Groups that their first node connects wholly need no more pairs.
        several = np.maximum.reduceat(root != centre, bounds[:-1])
        some = np.flatnonzero(np.repeat(several, np.diff(bounds)))
        for a, b in _pairs(np.concatenate([[0], np.cumsum(np.diff(bounds)[several])])) if len(some) else ():
            a, b = some[a], some[b]
            ok = (root[a] != root[b]) & ((lo[a] == hi[a]) | (block[a] != block[b]))
            a, b = _staying(sign, a[ok], b[ok], least)
            if len(a):
                root = _roots(len(node), np.concatenate([np.arange(len(node)), a]), np.concatenate([root, b]))
        moved = np.flatnonzero(root != np.arange(len(node)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])


def candidates(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all nodes of which some bucket holds a pair that pruning leaves."""
    buckets = nodes.select("node", F.posexplode("sign").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = spread_join(buckets, sizes, "bucket", nodes.count() * BANDS)
    dealt = _dealt(shared, "n", SIGN_BLOCK).join(nodes.select("node", "sign"), "node")
    dealt = dealt.select("bucket", "lo", "hi", "block", "node", "sign").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "node")
    return dealt.mapInArrow(_pruned, "a long, b long")


def _cross(n: np.ndarray, m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of n[i] and m[i] members, all pairs of members of each i, some at a time: i and the two places in its runs."""
    total = np.concatenate([[0], np.cumsum(n * m)])
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(total, total[at] + AT_ONCE, side="right")) - 1)
        i = np.repeat(np.arange(at, to), (n * m)[at:to])
        place = np.arange(total[at], total[to]) - total[i]
        yield i, place // m[i], place % m[i]
        at = to


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of common members of each set on the left (at least one) with each on the right.

    Frequent members count by products of slices of the membership matrices, rare ones by their pairs of sets, so that
    neither many members nor a frequent one make the work much larger than the result needs.
    """
    out = np.zeros((len(left), len(right)), np.float32)
    ids = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1]
    half = sum(len(s) for s in left)
    sides = []
    for own, sets in ((ids[:half], left), (ids[half:], right)):
        order = np.argsort(own, kind="stable")
        sides.append((own[order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]))
    (a, row), (b, col) = sides
    n, m = (np.bincount(x, minlength=int(ids.max()) + 1) for x in (a, b))
    first_a, first_b = np.cumsum(n) - n, np.cumsum(m) - m
    often = n * m * DENSE * DENSE > out.size
    dense = np.flatnonzero(often)
    width = max(1, (1 << 22) // max(out.shape))
    for at in range(0, len(dense), width):
        parts = []
        for count, first, sets, rows in ((n, first_a, row, len(left)), (m, first_b, col, len(right))):
            some = count[dense[at : at + width]]
            own = np.repeat(first[dense[at : at + width]], some) + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            part = np.zeros((rows, len(some)), np.float32)
            part[sets[own], np.repeat(np.arange(len(some)), some)] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    rare = np.flatnonzero(~often & (n > 0) & (m > 0))
    for i, x, y in _cross(n[rare], m[rare]):
        np.add.at(out.reshape(-1), row[first_a[rare[i]] + x] * len(right) + col[first_b[rare[i]] + y], np.float32(1))
    return out


def _links(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether the similarity of each set on the left with each on the right reaches the threshold."""
    common = common_counts(left, right)
    out = np.zeros(common.shape, bool)
    size = np.array([len(s) for s in right], np.float64)
    for i, own in enumerate(left):
        out[i] = common[i] >= THRESHOLD * (len(own) + size - common[i]) - 1e-9
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, links and root of each node in a pair of blocks. Columns: part, lo, hi, block, node, copies, text."""
    is_word = byte_table("blank")
    for table, bounds in _groups(batches, 3):
        lo, hi, block, node, copies = (table.column(i).to_numpy() for i in range(1, 6))
        texts = table.column(6)
        for start, end in zip(bounds[:-1], bounds[1:]):
            rows = np.arange(start, end)
            one = lo[start] == hi[start]
            left, right = (rows, rows) if one else (rows[block[rows] == lo[start]], rows[block[rows] == hi[start]])
            if len(rows) < 2 or not len(left) or not len(right):
                continue
            sets = []
            for text in texts.slice(start, len(rows)):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                sets.append(shingles(words_of(data, np.array([0, len(data)]), is_word)[0]))
            linked = _links([sets[i - start] for i in left], [sets[i - start] for i in right])
            links = np.zeros(len(rows), np.int64)
            if one:
                np.fill_diagonal(linked, False)
            else:
                links[right - start] = copies[left] @ linked
            links[left - start] += linked @ copies[right]
            a, b = np.nonzero(linked)
            root = _roots(len(rows), left[a] - start, right[b] - start)
            yield pa.RecordBatch.from_arrays([pa.array(node[rows]), pa.array(links), pa.array(node[rows][root])], names=["node", "links", "root"])


def classes(docs: DataFrame) -> DataFrame:
    """digest, doc_id (its least), copies, root (one number for each class), class_id and n_links for each distinct text with a word."""
    nodes = nodes_of(docs)
    near = checkpoint(components(candidates(nodes)).join(nodes.select("node", "digest", "doc_id", "copies", "weight"), "node"))
    sizes = near.groupBy("root").agg(F.count("*").alias("n"), F.sum("weight").alias("size"))
    near = spread_join(near, sizes, "root", near.count())
    # Copies fold before they are shuffled, so that a text comes once however often it occurs.
    texts = docs.groupBy(_row_key("text").alias("digest")).agg(F.first("text").alias("text"))
    whole = near.join(texts, "digest")
    dealt = _dealt(whole, "size", TEXT_BLOCK).select(F.col("root").alias("part"), "lo", "hi", "block", "node", "copies", "text")
    found = checkpoint(dealt.repartition("part", "lo", "hi").sortWithinPartitions("part", "lo", "hi", "node").mapInArrow(_verified, "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    every = nodes.select("node", "digest", "doc_id", "copies").join(links, "node", "left").join(grouped, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = every.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    return spread_join(every, named, "root", nodes.count()).select("digest", "doc_id", "copies", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def _has_word(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(f"[^{BLANK[1:]}"), F.lit(False))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and n_links, a row for each row of the input."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = docs.filter(_has_word("text")).select("doc_id", _row_key("text").alias("digest"))
    facts = checkpoint(classes(docs).select("digest", "class_id", "n_links", F.col("copies").alias("n")))
    total = facts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = spread_join(rows, facts, "digest", total).select("doc_id", "class_id", "n_links")
    return out.unionAll(docs.filter(~_has_word("text")).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class, the document of least id (of rows that repeat it, one); texts without words all stay.

    Who stays is decided on ids and digests; whole rows move once, to meet that decision.
    """
    text = F.col("text").cast("string")
    keyed = docs.select("doc_id", text.alias("text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("digest"))
    first = classes(keyed).groupBy("root").agg(F.min(order).alias("first")).select("root", "first.doc_id", "first.digest")
    times = keyed.select(F.col("doc_id").alias("__id"), _row_key("text").alias("__key")).groupBy("__id", "__key").agg(F.count("*").alias("times"))
    first = first.join(times, (F.col("digest") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))).select(F.col("root").alias("__root"), F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "times")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"))
    has_word = _has_word("text")
    kept = rows.filter(has_word).select("row", F.col("row.doc_id").alias("doc_id"), _row_key("text").alias("key"))
    kept = kept.join(first, (F.col("key") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    once = kept.filter("times > 1").dropDuplicates(["__root"])
    return kept.filter("times = 1").select("row.*").unionAll(once.select("row.*")).unionAll(rows.filter(~has_word).select("row.*"))
