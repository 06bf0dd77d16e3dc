"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its share of all words by weight, at most MOST times its own words; what a full source can't take is
shared among the others by weight. A document then has target / source size expected copies: a whole number, and a
fraction that is rounded. The fractions of a source are rounded in pairs: mass moves from one document to the other, in
words, until one of them is whole, at random such that each keeps its expectation. What a source takes in words thus
stays what it was until its last fraction is rounded, and ends within one document of the target.

The pairing is a reduction tree. Rows are dealt by a hash to leaves of bounded size; a leaf rounds all but at most one
document of each source and hands that one on; groups of leaves are combined likewise up to the root. Leaves, order and
random numbers depend on the rows only, so that reruns agree however the table is split.

Defined cases: a null text has no words and is taken 0 times; the rows without a source are a source of their own, the
last. Rows that repeat (equal source, id and text) are one unit: of n of them with a fraction p, the whole part of n * p is
taken once more, and what is left of n * p is rounded like the fraction of a single row. A null id is not the id "None".
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANK, FEW_GROUPS, checkpoint, repeated, row_digest

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken at most so many times.
MOST = 3
#: Rows in a leaf, about, and nodes that one node of the tree combines.
LEAF_ROWS, FAN_IN = 1 << 14, 64
SEED = 20240607


def _numbered(sizes: DataFrame) -> DataFrame:
    """The sources with `number`, their place in code point order from 0, null last; no task sees them all."""
    spread = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    spread = checkpoint(spread)
    before, first = 0, []
    for part, n in spread.groupBy("part").count().orderBy("part").collect():  # a row for each partition
        first.append((part, before))
        before += n
    first = spread.sparkSession.createDataFrame(first, "part int, first long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return spread.join(F.broadcast(first), "part").withColumn("number", F.col("first") + place - 1).drop("part", "first")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target from source and source_size.

    Each round shares what full sources leave among the others by weight; those that then stand above MOST times their
    size are full in the next. The level of a unit of weight only rises, so rounds end when no source fills up any more.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    most = F.col("source_size").cast("double") * MOST
    df = checkpoint(_numbered(sizes).withColumn("weight", weight).withColumn("most", most).drop("number"))
    total = df.agg(F.sum(F.col("source_size").cast("double"))).first()[0] or 0.0
    level = 0.0
    while True:
        full = F.col("most") <= F.col("weight") * level
        taken, rest = df.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        new = (total - (taken or 0.0)) / rest if rest else level
        if new <= level:
            break
        level = new
    return df.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def _uniform(*key) -> float:
    return int.from_bytes(hashlib.blake2b(repr((SEED, *key)).encode(), digest_size=7).digest(), "big") / 2.0**56


def pivot(rows: list[tuple], level: int) -> tuple[list[tuple], tuple | None]:
    """Rounds (key, size, p) with 0 < p < 1: the rounded ones as (key, 0 or 1), and the one that may be left."""
    done, held = [], None
    for key, size, p in rows:
        if held is None:
            held = key, size, p
            continue
        other, its_size, its_p = held
        # Up moves words from this document to the held one, down the other way; each ends with one of them whole.
        up = min((1 - its_p) * its_size, p * size)
        down = min(its_p * its_size, (1 - p) * size)
        if _uniform(level, other, key) * (up + down) < down:
            moved, sure_held, sure_this = up, (1 - its_p) * its_size <= p * size, p * size <= (1 - its_p) * its_size
            its_p, p = (1.0 if sure_held else its_p + moved / its_size), (0.0 if sure_this else p - moved / size)
        else:
            moved, sure_held, sure_this = down, its_p * its_size <= (1 - p) * size, (1 - p) * size <= its_p * its_size
            its_p, p = (0.0 if sure_held else its_p - moved / its_size), (1.0 if sure_this else p + moved / size)
        held = None
        for state in ((other, its_size, its_p), (key, size, p)):
            if state[2] <= 0.0 or state[2] >= 1.0:
                done.append((state[0], int(state[2] >= 1.0)))
            else:
                held = state
    return done, held


UNIT = "node long, source string, doc string, sig long, rows long, size long, base long, more long, p double, up long"


def _rounded(level: int, last: bool):
    def rounded(part: pa.Table) -> pa.Table:
        source, doc, sig, size = (part.column(c).to_pylist() for c in ("source", "doc", "sig", "size"))
        p, up = part.column("p").to_pylist(), part.column("up").to_pylist()
        by_source: dict = {}
        # Largest first, so that the last one held tends to be small.
        for i in sorted(range(len(doc)), key=lambda i: (-size[i], doc[i] is None, doc[i] or "", sig[i])):
            by_source.setdefault(source[i], []).append(i)
        for own in by_source.values():
            # A unit is named by all that tells it from others of its source; no text form folds two of them.
            at = {(doc[i], sig[i], size[i]): i for i in own}
            done, held = pivot([(name, size[i], p[i]) for name, i in at.items()], level)
            for name, one_more in done:
                up[at[name]] = one_more
            if held is not None:
                name, _, p[at[name]] = held
                if last:
                    up[at[name]] = int(_uniform("last", name) < held[2])
        for name, cells in (("p", pa.array(p, pa.float64())), ("up", pa.array(up, pa.int64()))):
            part = part.set_column(part.schema.get_field_index(name), name, cells)
        return part

    return rounded


def units(docs: DataFrame) -> DataFrame:
    """source, doc, sig, rows, size, source_size, target, base and more of each distinct (source, doc_id, text).

    Each of the `rows` equal rows is taken `base` times, and `more` of them once more.
    """
    text = F.col("text").cast("string")
    size = F.when(text.isNull(), 0).otherwise(F.size(F.array_remove(F.split(text, f"{BLANK}+"), ""))).cast("long")
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("string").alias("doc"), F.xxhash64(text).alias("sig"), size.alias("size"))
    each = checkpoint(rows.groupBy("source", "doc", "sig", "size").agg(F.count("*").alias("rows")))
    wanted = checkpoint(targets(each.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))))
    each = _with_target(each, wanted)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    each = each.withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(0.0)).withColumn("base", F.floor(F.col("expected") + 1e-9).cast("long"))
    # Of equal rows as many are taken once more as the fraction makes whole; only what then is left is rounded.
    extra = (F.col("expected") - F.col("base")) * F.col("rows")
    each = each.withColumn("extra", F.greatest(F.lit(0.0), extra)).withColumn("more", F.floor(F.col("extra") + 1e-9).cast("long"))
    each = each.withColumn("p", F.col("extra") - F.col("more"))
    columns = ["source", "doc", "sig", "rows", "size", "base"]
    parts = [each.filter("p <= 1e-9").select(*columns, "more")]
    open_ = each.filter("p > 1e-9")
    nodes = max(1, -(-open_.count() // LEAF_ROWS))
    state = open_.select(F.pmod(F.xxhash64("doc", "sig"), F.lit(nodes)).cast("long").alias("node"), *columns, "more", "p", F.lit(None).cast("long").alias("up"))
    keys, level = ["node"], 0
    while True:
        state = checkpoint(state.groupBy(*keys).applyInArrow(_rounded(level, nodes == 1), UNIT))
        parts.append(state.filter("up is not null").select(*columns, (F.col("more") + F.col("up")).alias("more")))
        if nodes == 1:
            break
        state = state.filter("up is null").withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        nodes, level = -(-nodes // FAN_IN), level + 1
        # A node of the tree holds at most one unit of each source and child; many sources are dealt over parts.
        spread = max(1, -(-state.count() // (LEAF_ROWS * nodes)))
        keys = [F.col("node"), F.pmod(F.xxhash64("source"), F.lit(spread))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return _with_target(out, wanted)


def _with_target(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Joins the targets, sent out whole while sources are few and else dealt by source and a salt."""
    wanted = wanted.select(F.col("source").alias("__source"), "source_size", "target")
    if wanted.count() <= FEW_GROUPS:
        return df.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    salts = 64
    wanted = wanted.withColumn("__of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    df = df.withColumn("__salt", F.pmod(F.xxhash64("doc", "sig"), F.lit(salts)))
    return df.join(wanted, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__salt") == F.col("__of"))).drop("__source", "__of", "__salt")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row."""
    found = checkpoint(units(docs))
    lots = F.array(F.struct((F.col("base") + 1).alias("copies"), F.col("more").alias("times")), F.struct(F.col("base").alias("copies"), (F.col("rows") - F.col("more")).alias("times")))
    each = found.select("doc", "size", "source_size", "target", F.inline(lots))
    out = repeated(each, "times")
    return out.select(F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it.

    Rows that share source, id and text but differ elsewhere are kinds of one unit; they are taken in the order of a hash.
    """
    key = [F.col("source").cast("string").alias("source"), F.col("doc_id").cast("string").alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("sig")]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_digest(docs).alias("kind"), *key)
    counts = checkpoint(keyed.groupBy("source", "doc", "sig", "kind").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("source", "doc", "sig").orderBy("kind").rowsBetween(Window.unboundedPreceding, -1))
    same = F.col("c.source").eqNullSafe(F.col("u.source")) & F.col("c.doc").eqNullSafe(F.col("u.doc")) & (F.col("c.sig") == F.col("u.sig"))
    placed = counts.withColumn("before", F.coalesce(before, F.lit(0))).alias("c").join(units(docs).alias("u"), same)
    more = F.least(F.greatest(F.col("u.more") - F.col("c.before"), F.lit(0)), F.col("c.n"))
    placed = placed.select(F.col("c.sig").alias("own_sig"), F.col("c.kind").alias("own_kind"), (F.col("u.base") * F.col("c.n") + more).alias("times")).filter("times > 0")
    # Equal rows fold before they are shuffled. Hashes of the text and of all columns name a row, in one shuffle.
    rows = keyed.groupBy("sig", "kind").agg(F.first("row").alias("row"))
    kept = rows.join(placed, (F.col("sig") == F.col("own_sig")) & (F.col("kind") == F.col("own_kind"))).select("row", "times")
    return repeated(kept, "times").select("row.*")
