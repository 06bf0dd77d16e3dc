"""Registered queries for single relational operators, aggregates and array functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, ids, text
from ..functions.weights import floored
from ..operators.incremental import new_rows
from ..operators.modes import distinct_union, mode
from ..sources.readers import highest_revisions
from ..streaming import incremental as streaming
from .catalog import query, with_views
from .views import table, view


@query("select l_returnflag, count(*) as n, count(*) filter (where l_quantity > 25) as n_many, cast(count(distinct l_suppkey) as bigint) as n_suppliers, round(sum(l_extendedprice), 2) as price, round(avg(l_discount), 6) as discount, min(l_shipdate) as first_day, max(l_shipdate) as last_day from lineitem group by l_returnflag")
def grouped_counts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem")
    return t.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 25).alias("n_many"), F.count_distinct("l_suppkey").alias("n_suppliers"), F.round(F.sum("l_extendedprice"), 2).alias("price"), F.round(F.avg("l_discount"), 6).alias("discount"), F.min("l_shipdate").alias("first_day"), F.max("l_shipdate").alias("last_day"))


@query("select cast(o_orderdate as date) as day, count(*) as n from orders group by 1")
def daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))


@query("select l_partkey, count(*) as n from lineitem group by 1 order by n desc, l_partkey limit 10")
def top_cited(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(10)


@query("select (select count(*) from part) as n_part, (select count(*) from lineitem) as n_lineitem, (select count(*) from orders) as n_orders, (select count(*) from events) as n_events")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    names = ("part", "lineitem", "orders", "events")
    return spark.sql("select " + ", ".join(f"(select count(*) from {{{n}}}) as n_{n}" for n in names), **{n: table(spark, d, n) for n in names})


@query("select * exclude (p_name, p_size), p_size + 1 as size from part")
def excluded_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").withColumn("size", F.col("p_size") + 1).drop("p_name", "p_size")


@query("select p_partkey as id, p_name as name, p_brand as label from part")
def packed_and_unpacked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("label")).alias("s")).select("s.*")


@query("select o_orderkey, case when o_totalprice > 100000 then 'high' when o_totalprice > 1000 and o_orderstatus in ('F', 'O') then 'mid' when o_orderpriority like '1%' then 'urgent' else coalesce(nullif(o_orderstatus, 'P'), 'none') end as label from orders where o_orderpriority not like '5%' and o_orderkey is not null")
def labelled_orders(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").filter(~F.col("o_orderpriority").like("5%") & F.col("o_orderkey").isNotNull())
    label = F.when(F.col("o_totalprice") > 100000, "high").when((F.col("o_totalprice") > 1000) & F.col("o_orderstatus").isin("F", "O"), "mid").when(F.col("o_orderpriority").startswith("1"), "urgent")
    return t.select("o_orderkey", label.otherwise(F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none"))).alias("label"))


def between_open(c: str, first: str | None, last: str | None):
    """In an inclusive range of dates that may be open at either end; a null date isn't."""
    ok = F.col(c).isNotNull()
    ok = ok & (F.to_date(c) >= F.lit(first).cast("date")) if first else ok
    return ok & (F.to_date(c) <= F.lit(last).cast("date")) if last else ok


@query("select o_orderkey from orders where cast(o_orderdate as date) >= date '1996-01-01' and o_orderkey % 2 = 0 union all select o_orderkey from orders where cast(o_orderdate as date) between date '1995-03-01' and date '1995-04-01'")
def date_ranges(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders")
    return t.filter(between_open("o_orderdate", "1996-01-01", None) & (F.col("o_orderkey") % 2 == 0)).select("o_orderkey").unionByName(t.filter(between_open("o_orderdate", "1995-03-01", "1995-04-01")).select("o_orderkey"))


@query("select n_nationkey, r_name, n_name from nation join region on n_regionkey = r_regionkey")
def inner_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name", "n_name")


@query("select c_custkey, o.n, d.label from customer left join (select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1) o on o_custkey = c_custkey left join (select 'default' as label) d on true")
def left_and_default_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").join(F.broadcast(spark.sql("select 'default' as label")), F.lit(True), "left").select("c_custkey", "n", "label")


@query("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderkey % 4 = 0)")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "orders").filter("o_orderkey % 4 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return new_rows(table(spark, d, "customer"), known, ["c_custkey"]).select("c_custkey", "c_name")


@query("select p_partkey from part where p_partkey in (select l_partkey from lineitem where l_quantity > 49)")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    hit = table(spark, d, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").join(hit, "p_partkey", "left_semi").select("p_partkey")


@query("with a as (select l_partkey, l_suppkey, count(*) as n from lineitem where l_linenumber = 1 group by 1, 2), b as (select l_partkey, l_suppkey, count(*) as m from lineitem where l_linenumber = 2 group by 1, 2) select l_partkey, l_suppkey, n, m from a join b using (l_partkey, l_suppkey)")
def composite_key_join(spark: SparkSession, d: str) -> DataFrame:
    t, keys = table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"]
    side = lambda line, name: t.filter(F.col("l_linenumber") == line).groupBy(*keys).agg(F.count("*").alias(name))
    return side(1, "n").join(side(2, "m"), keys)


@query("with k as (select * from (values ('Brand#1', 5), ('Brand#12', 7), ('Brand#23', 9)) v(brand, size)) select p_partkey, p_brand from part join k on p_brand = brand where p_size <> size")
def parameter_join(spark: SparkSession, d: str) -> DataFrame:
    zipped = spark.range(1).select(F.explode(F.arrays_zip(F.array(*map(F.lit, ("Brand#1", "Brand#12", "Brand#23"))).alias("brand"), F.array(*map(F.lit, (5, 7, 9))).alias("size"))).alias("k"))
    k = zipped.select(F.col("k.0").alias("brand"), F.col("k.1").alias("size")) if "0" in zipped.schema["k"].dataType.names else zipped.select("k.*")
    return table(spark, d, "part").join(F.broadcast(k), F.col("p_brand") == F.col("brand")).filter("p_size <> size").select("p_partkey", "p_brand")


@query("select coalesce(a.k, b.k) as k, a.n as left_n, b.n as right_n from (select p_size as k, count(*) as n from part where p_size < 30 group by 1) a full outer join (select p_size as k, count(*) as n from part where p_size > 20 group by 1) b on a.k = b.k")
def full_outer_join(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "part")
    a = t.filter("p_size < 30").groupBy(F.col("p_size").alias("k")).agg(F.count("*").alias("left_n"))
    b = t.filter("p_size > 20").groupBy(F.col("p_size").alias("k")).agg(F.count("*").alias("right_n"))
    return a.join(b, "k", "full_outer").select("k", "left_n", "right_n")


@query("select p_type, p_brand, count(*) as n, median(p_retailprice) as price, grouping(p_type) as all_types, grouping(p_brand) as all_brands from part group by grouping sets ((), (p_type), (p_brand), (p_type, p_brand))")
def grouping_set_medians(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql("select p_type, p_brand, count(*) as n, median(p_retailprice) as price, cast(grouping(p_type) as bigint) as all_types, cast(grouping(p_brand) as bigint) as all_brands from {part} group by grouping sets ((), (p_type), (p_brand), (p_type, p_brand))", part=table(spark, d, "part"))


@query("select p_brand, min(p_type) as type from (select p_brand, p_type, rank() over (partition by p_brand order by count(*) desc) as r from part group by 1, 2) where r = 1 group by 1")
def modes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(mode("p_type").alias("type"))


@query("select l_suppkey, array_to_string(list_sort(list_distinct(flatten(list([l_returnflag, l_linestatus])))), ',') as flags, max(l_returnflag) as any_flag, min(l_linestatus) as first_status from lineitem group by 1")
def flattened_lists(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").withColumn("a", F.array("l_returnflag", "l_linestatus"))
    return t.groupBy("l_suppkey").agg(F.array_join(distinct_union("a"), ",").alias("flags"), F.max("l_returnflag").alias("any_flag"), F.min("l_linestatus").alias("first_status"))


@query("select greatest(13.46, min(p_retailprice)) as floor, greatest(13.46, min(case when p_size < 0 then p_retailprice end)) as of_none from part")
def scalar_floor(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").agg(F.greatest(F.lit(13.46), F.min("p_retailprice")).alias("floor"), F.greatest(F.lit(13.46), F.min(F.when(F.col("p_size") < 0, F.col("p_retailprice")))).alias("of_none"))


@query("select s_suppkey, case when b < 0 then 0.0 else b end as balance, coalesce(b < 0, false) as is_floored from (select s_suppkey, case when s_suppkey % 7 = 0 then null else s_acctbal end as b from supplier)")
def floored_values(spark: SparkSession, d: str) -> DataFrame:
    value, flag = floored(F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")), 0.0)
    return table(spark, d, "supplier").select("s_suppkey", value.alias("balance"), flag.alias("is_floored"))


@query("select event_type, user_id, value, sum(value) over (partition by event_type, user_id order by ts, event_id) as running from events")
def running_sums(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("event_type", "user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "events").select("event_type", "user_id", "value", F.sum("value").over(w).alias("running"))


@query("select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as r from orders) where r = 1")
def best_per_key(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("r", F.row_number().over(w)).filter("r = 1").select("o_custkey", "o_orderkey")


@query("select 'ipg' || lpad(cast(p_size as varchar), 6, '0') as base, max(p_partkey % 6) as revision from part group by 1")
def highest_revision(spark: SparkSession, d: str) -> DataFrame:
    revision = F.col("p_partkey") % 6
    name = F.concat(F.lit("ipg"), F.lpad(F.col("p_size").cast("string"), 6, "0"), F.when(revision > 0, F.concat(F.lit("_r"), revision.cast("string"))).otherwise(""), F.lit(".zip"))
    return highest_revisions(table(spark, d, "part").select(name.alias("file"))).select("base", F.col("revision").cast("long").alias("revision"))


@query("select p_partkey, least(greatest(p_size, 10), 40) as clamped, coalesce(case when p_size < 15 then p_size end, case when p_partkey % 2 = 0 then 100 end, -1) as fallback from part")
def clamp_and_fallback(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.least(F.greatest("p_size", F.lit(10)), F.lit(40)).alias("clamped"), F.coalesce(F.when(F.col("p_size") < 15, F.col("p_size")), F.when(F.col("p_partkey") % 2 == 0, 100), F.lit(-1)).alias("fallback"))


ARRAYS = "select p_partkey, ['b' || cast(p_size % 5 as varchar), 'a', 'b' || cast(p_size % 3 as varchar), 'a'] as xs from part"


@query(f"""with r as ({ARRAYS}) select p_partkey, array_to_string(list_sort(list_distinct(xs)), ',') as sorted_unique, array_to_string(list_filter(xs, lambda x: x like 'b%'), ',') as filtered, list_filter(xs, lambda x: x = 'b1')[1] as first_match, xs[9] as beyond,
    array_to_string(list_sort(list_filter(list_distinct(xs), lambda x: not list_contains(['a', 'b1'], x))), ',') as without, case when list_contains(xs, 'b4') then 1 else 0 end as has_b4 from r""")
def array_functions(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    b = lambda n: F.concat(F.lit("b"), (F.col("p_size") % n).cast("string"))
    xs = F.array(b(5), F.lit("a"), b(3), F.lit("a"))
    return part.select(
        "p_partkey", F.array_join(F.array_sort(F.array_distinct(xs)), ",").alias("sorted_unique"), F.array_join(F.filter(xs, lambda x: x.startswith("b")), ",").alias("filtered"), F.get(F.filter(xs, lambda x: x == "b1"), F.lit(0)).alias("first_match"), F.get(xs, F.lit(8)).alias("beyond"),
        F.array_join(F.array_sort(F.array_except(xs, F.array(F.lit("a"), F.lit("b1")))), ",").alias("without"), F.when(F.exists(xs, lambda x: x == "b4"), 1).otherwise(0).alias("has_b4"),
    )


@query("select event_id, cast(json_extract_string(props, '$.k') as int) as k, json_extract_string(props, '$.none') as missing from events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.get_json_object("props", "$.none").alias("missing"))


@query("""select o_orderkey, 'https://doi.org/10.5555/' || cast(o_orderkey as varchar) as link, cast(o_orderkey as varchar) as tail, case when o_orderkey % 3 = 0 then '0000-0001-2345-' || lpad(cast(o_orderkey % 10000 as varchar), 4, '0') end as orcid, 'T' || cast(o_custkey as varchar) as topic, o_orderkey % 2 = 0 as is_url, 'ab' as clean from orders""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    orcid = F.when(key % 3 == 0, F.concat(F.lit("https://orcid.org/0000‑0001-2345-"), F.lpad((key % 10000).cast("string"), 4, "0"))).otherwise(F.lit("0000-0001-2345-678X"))
    return table(spark, d, "orders").select(
        "o_orderkey", ids.clean_link(F.concat(F.lit("https://doi.org/10.5555/"), key.cast("string"), F.lit("//#frag"))).alias("link"), ids.last_segment(F.concat(F.lit("https://openalex.org/"), key.cast("string"))).alias("tail"), ids.norm_orcid(orcid).alias("orcid"),
        ids.topic_id(F.concat(F.lit("https://openalex.org/T"), F.col("o_custkey").cast("string"))).alias("topic"), ids.is_url(F.when(key % 2 == 0, "https://example.org/x").otherwise("ftp://example.org/x")).alias("is_url"), text.without_control(F.lit("a\u0001b�")).alias("clean"),
    )


@query("""select o_orderkey, cast(o_orderdate as date) as d, case when o_orderkey % 4 = 0 then '1970-01-01T00:00:00.000+00:00' else strftime(o_orderdate, '%Y-%m-%dT00:00:00.000+00:00') end as shown, cast(case when o_orderkey % 5 = 0 then year(o_orderdate) when year(o_orderdate) <= 1998 then 1998 end as int) as work_year from orders""")
def date_functions(spark: SparkSession, d: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(key % 4 == 0, "unknown").otherwise(F.concat(day, F.lit("T00:00:00+99:00")))
    late = F.year("o_orderdate") <= 1998
    return table(spark, d, "orders").select("o_orderkey", dates.strict_date(day).alias("d"), dates.search_format(dates.published_at(raw)).alias("shown"), dates.work_year(F.when(key % 5 == 0, F.year("o_orderdate")).otherwise(F.lit(17)), F.when(late, "1998-02"), 2025).alias("work_year"))


@query("select p_partkey, p_name from part order by p_partkey limit 100 offset 50")
def page_of_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").orderBy("p_partkey").offset(50).limit(100).select("p_partkey", "p_name")


@query("select p_brand, round(sum(p_retailprice), 2) as total from part group by 1 order by total desc nulls last")
def ordered_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.round(F.sum("p_retailprice"), 2).alias("total")).orderBy(F.desc_nulls_last("total"))


SAMPLED = "md5(cast(l_orderkey as {0}) || '/' || cast(l_linenumber as {0}) || '/' || cast(l_partkey as {0}) || '/7')"


@query(f"select l_orderkey, l_linenumber from lineitem order by {SAMPLED.format('varchar')}, l_orderkey, l_linenumber limit 100")
def sampled_rows(spark: SparkSession, d: str) -> DataFrame:
    """A sampling operator: 100 rows in the order of a hash of their keys and a seed, whatever the partitioning."""
    return table(spark, d, "lineitem").orderBy(F.expr(SAMPLED.format("string")), "l_orderkey", "l_linenumber").limit(100).select("l_orderkey", "l_linenumber")


@query("select distinct event_type, user_id from events")
def stream_distinct_loads(spark: SparkSession, d: str) -> DataFrame:
    """An availableNow stream over files with a checkpoint as ledger: each file once, new keys appended."""
    return streaming.load_new(spark, f"{d}/events.parquet", table(spark, d, "events").schema, ["event_type", "user_id"])


@query("select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2")
def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by day with a watermark of seven days, run as a stream to the end of its input."""
    return streaming.daily_counts(spark, f"{d}/events.parquet", table(spark, d, "events").schema)
