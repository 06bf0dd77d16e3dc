"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat_format, decontamination, language_id, mixing, ngram_join, pii, quality_model, quality_rules, secret_scan, sharding
from .common import shared_folder, table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(conversations.unionByName(extra))


OP1_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, length(text) + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '</turn>', ''))) // 7
        + length(array_to_string(regexp_extract_all(text, '#{3,}'), '')) - 2 * len(regexp_extract_all(text, '#{3,}')) as chars from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars + length(role) + 14) as bigint) as formatted_chars, cast(count(*) as double) as path_score
from e group by conv_id
"""


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), quality_rules.passes(quality_rules.CURRENT).alias("kept"), "n_lines", "n_shouts", "n_stutters", "fail_bits",
    )


OP4_SQL = r"""
with t as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (select rid, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
win as (select rid, i, array_to_string(words[i : i + 7], ' ') as g from (select rid, words, unnest(range(1, greatest(len(words) - 6, 1))) as i from w)),
dup as (select rid, g from win group by rid, g having count(*) > 1),
cov as (select rid, count(distinct p) as c from (select rid, unnest(range(i, i + 8)) as p from win join dup using (rid, g)) group by rid),
m as (select w.doc_id, cast(len(words) as bigint) as n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(length(regexp_replace(text, '[^!]', '', 'g')) as bigint) as n_shouts,
        cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(len(lines) as bigint) as n_lines,
        cast(coalesce(cov.c, 0) as bigint) as n_repeat_words,
        cast((select count(*) from (select unnest(range(2, len(words) + 1)) as i) where words[i] = words[i - 1]) as bigint) as n_stutters
      from w left join cov using (rid)),
b as (select *, cast((case when n_words < 20 then 1 else 0 end) + (case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end)
        + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when 10 * n_shouts > n_words then 8 else 0 end)
        + (case when 10 * n_stutters > 3 * n_words then 16 else 0 end) + (case when word_chars < 2 * n_words then 32 else 0 end)
        + (case when word_chars > 20 * n_words then 64 else 0 end) + (case when n_lines > 3 and 2 * n_dup_lines > n_lines then 128 else 0 end) as bigint) as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits % 4 <> 0 as base_failed, fail_bits = 0 as kept, n_lines, n_shouts, n_stutters, fail_bits from b
"""


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of both policies rejects, from one written ledger."""
    book = quality_rules.written(table(spark, sf_dir, "documents"), os.path.join(shared_folder(spark), f"ledger-{uuid.uuid4().hex}"))
    return quality_rules.ablations(book, quality_rules.BASE).unionByName(quality_rules.ablations(book, quality_rules.CURRENT))


_RULES = ", ".join(f"('{policy.version}', '{name}', {1 << b}, {policy.mask})" for policy in (quality_rules.BASE, quality_rules.CURRENT) for b, (name, _) in enumerate(quality_rules.RULES) if name in policy.rules)

ABLATIONS_SQL = f"""
with book as ({OP4_SQL}), rules(version, rule, bit, mask) as (values {_RULES})
select version, rule, count(*) filter (where fail_bits & bit <> 0) as n_failed, count(*) filter (where fail_bits & mask = bit) as n_failed_alone,
       count(*) filter (where fail_bits & mask = 0) as n_kept, count(*) filter (where fail_bits & mask & ~bit = 0) as n_kept_without
from rules, book group by version, rule
"""


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
with recursive t as (select row_number() over () as rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
s as (select distinct rid, array_to_string(words[i : i + 4], ' ') as g from (select rid, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from t where len(words) > 0)),
n as (select rid, count(*) as n from s group by rid),
c as (select a.rid as a, b.rid as b, count(*) as c from s a join s b on a.g = b.g and a.rid <> b.rid group by 1, 2),
l as (select c.a, c.b from c join n x on x.rid = c.a join n y on y.rid = c.b where 5 * c.c >= 4 * (x.n + y.n - c.c)),
r as (select rid, rid as seen from t union select r.rid, l.b from r join l on l.a = r.seen),
k as (select r.rid, min(t.doc_id) as class_id from r join t on t.rid = r.seen group by 1)
select t.doc_id, k.class_id, (select count(*) from l where l.a = t.rid) as n_links from t join k using (rid)
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
with fold as (select row_number() over () as rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words from documents),
item as (select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words from benchmark),
sized as (select item_id, words, least(len(words), 10) as k from item where len(words) > 0),
win as (select distinct item_id, k, array_to_string(words[i : i + k - 1], ' ') as g from (select item_id, words, k, unnest(range(1, len(words) - k + 2)) as i from sized)),
doc as (select rid, k, i, array_to_string(words[i : i + k - 1], ' ') as g from (select rid, words, k, unnest(range(1, greatest(len(words) - k + 2, 1))) as i from fold cross join (select distinct k from sized))),
hit as (select rid, i, k, item_id from doc join win using (k, g)),
cov as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + k)) as p from hit) group by rid),
ids as (select rid, count(*) as n_items, string_agg(id, ',' order by id) as joined from (select distinct rid, cast(item_id as varchar) as id from hit) group by rid)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(joined, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from fold left join cov using (rid) left join ids using (rid)
"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_ngram_join": op2_ngram_join,
        "op3_quality_model": op3_quality_model,
        "op4_quality_rules": op4_quality_rules,
        "rule_ablations": rule_ablations,
        "op5_pii": op5_pii,
        "op6_mixing": op6_mixing,
        "op7_language_id": op7_language_id,
        "op8_secret_scan": op8_secret_scan,
        "op9_decontamination": op9_decontamination,
        "op10_sharding": op10_sharding,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": OP1_SQL, "op2_ngram_join": OP2_SQL, "op4_quality_rules": OP4_SQL, "rule_ablations": ABLATIONS_SQL, "op9_decontamination": OP9_SQL}
