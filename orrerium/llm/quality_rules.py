"""Quality rules as a bitmask ledger, in DataFrame operations only.

Each rule is evaluated once per text. The ledger keeps the measurements and one bit per failed rule, so that any
number of policies (a version and a mask of rules in force) and every ablation come from bit operations on it. Written
as a table (`written`), it answers them without a second look at the texts.

Defined cases: a null text counts as an empty one; an empty text has no words and fails `few_words`. Columns of the
input keep their values whatever their names: the input row travels as one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK

#: Words in a window whose repetition counts.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouts", "n_stutters")

#: name -> condition over the measurements under which a text fails. The place in this list is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols_per_word", "10 * n_symbols > n_words"),
    ("shouts_per_word", "10 * n_shouts > n_words"),
    ("stutters_per_word", "10 * n_stutters > 3 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("repeated_lines", "n_lines > 3 and 2 * n_dup_lines > n_lines"),
)


@dataclass(frozen=True)
class Policy:
    """A version and the rules in force in it."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [name for name, _ in RULES]
        return sum(1 << names.index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
CURRENT = Policy("2024.1", tuple(name for name, _ in RULES))


def measured(docs: DataFrame) -> DataFrame:
    """The input row as struct `row`, and the measurements of MEASURES as long columns."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    df = df.withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    df = df.withColumn("words", F.array_remove(F.split("text", f"{BLANK}+"), ""))
    df = df.withColumn("lines", F.expr(r"filter(split(text, '\n'), x -> rlike(x, '[^ \\t\\n\\x0B\\f\\r]'))"))
    df = df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
            "n_shouts": (F.length("text") - F.length(F.translate("text", "!", ""))).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_stutters": F.expr("cast(size(filter(words, (w, i) -> w <=> get(words, i - 1))) as long)"),
            "windows": F.expr(f"case when size(words) >= {WINDOW} then transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))) else array() end"),
        }
    )
    # Windows that occur twice stand next to each other once sorted; most texts have none and skip the sort.
    df = df.withColumn("sorted", F.expr("case when size(array_distinct(windows)) < size(windows) then sort_array(transform(windows, (h, i) -> struct(h, i))) else array() end"))
    df = df.withColumn("at", F.expr("sort_array(filter(transform(sorted, (x, k) -> if(x.h <=> get(sorted, k - 1).h or x.h <=> get(sorted, k + 1).h, x.i, null)), x -> x is not null))"))
    df = df.withColumn("n_repeat_words", F.expr(f"aggregate(transform(at, (p, k) -> least({WINDOW}, coalesce(get(at, k + 1), p + {WINDOW}) - p)), 0L, (a, x) -> a + x)"))
    return df.select("row", *MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """`row`, the measurements, and `fail_bits`: bit b is set if the text fails rule b of RULES."""
    df = measured(docs)
    bits = [F.when(F.expr(condition), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")) for b, (_, condition) in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    # A generator of one row: no filter on the ledger can be moved below it, where it would evaluate the rules again.
    entry = F.struct(*MEASURES, total.alias("fail_bits"))
    return df.select("row", F.inline(F.array(entry)))


def written(docs: DataFrame, path: str) -> DataFrame:
    """The ledger as a Parquet table, without the texts: doc_id, the measurements and `fail_bits`."""
    ledger(docs).select(F.col("row.doc_id").alias("doc_id"), *MEASURES, "fail_bits").write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: texts that fail it, that fail no other (those that dropping the rule returns), and kept.

    The ledger is first folded to one row per distinct bit pattern, of which there are at most 2 to the number of rules.
    """
    mask = policy.mask
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << b).cast("long").alias("bit")) for b, (name, _) in enumerate(RULES) if name in policy.rules])
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        count(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("r.bit")).alias("n_failed_alone"),
        count(F.col("bits") == 0).alias("n_kept"),
        count(F.col("bits").bitwiseAND(F.bitwise_not("r.bit")) == 0).alias("n_kept_without"),
        F.lit(policy.version).alias("version"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the current policy keeps, with their own columns."""
    return ledger(docs).filter(passes(CURRENT)).select("row.*")
