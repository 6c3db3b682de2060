"""Queries for single column functions, on feeds and on the test tables themselves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings import oracle
from bindings.registry import query
from tidemark.functions import keys, labels, numeric, parse
from tidemark.operators.routing import lost_in_parsing
from tidemark.plans.gold import with_load_time


def tally(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@query("clean_text", "B01", f"""select {', '.join(f'{oracle.clean(c)} as {c}' for c in oracle.INFO_TEXT)}, count(*) as n
  from bronze_hospital_info group by all""")
def _(c):
    cleaned = parse.clean_text_columns(c.bronze("hospital_info"))
    return tally(cleaned, *oracle.INFO_TEXT)


@query("parse_double", "B02", f"select score, denominator, {oracle.num('score')} as score_value, {oracle.num('denominator')} as denominator_value, count(*) as n from bronze_complications_deaths group by all")
def _(c):
    return tally(c.bronze("complications_deaths"), "score", "denominator",
                 parse.to_double(F.col("score")).alias("score_value"),
                 parse.to_double(F.col("denominator")).alias("denominator_value"))


@query("parse_double_strict", "B02", """select cast(sum(case when regexp_matches(x, '^\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$') then 1 else 0 end) as bigint) as numbers,
  count(*) as n, p_size from (select p_size, cast(p_retailprice as varchar) || case when p_size % 3 = 0 then 'd' else '' end as x from part) as t group by p_size""")
def _(c):
    text = F.concat(F.col("p_retailprice").cast("string"), F.when(F.col("p_size") % 3 == 0, "d").otherwise(""))
    return c.table("part").groupBy("p_size").agg(F.count(parse.to_double(text, strict=True)).alias("numbers"),
                                                F.count(F.lit(1)).alias("n"))


@query("parse_int", "B03", f"""select x, {oracle.whole('x')} as v, count(*) as n from (
  select cast(l_extendedprice as varchar) as x from lineitem union all select hospital_overall_rating from bronze_hospital_info
  union all select cast(o_totalprice as varchar) || '00000000' from orders) as t group by all""")
def _(c):
    text = (c.table("lineitem").select(F.col("l_extendedprice").cast("string").alias("x"))
            .unionByName(c.bronze("hospital_info").select(F.col("hospital_overall_rating").alias("x")))
            .unionByName(c.table("orders").select(F.concat(F.col("o_totalprice").cast("string"), F.lit("00000000")).alias("x"))))
    return tally(text, "x", parse.to_int(F.col("x")).alias("v"))


@query("parse_date", "B04", f"select end_date, {oracle.day('end_date')} as d, count(*) as n from bronze_unplanned_visits group by all")
def _(c):
    return tally(c.bronze("unplanned_visits"), "end_date", parse.to_day(F.col("end_date")).alias("d"))


@query("yes_no_flags", "B05 B06", f"""select emergency_services, meets_criteria_for_birthing_friendly_designation as birthing,
  {oracle.flag('emergency_services')} as emergency_flag, coalesce({oracle.flag('meets_criteria_for_birthing_friendly_designation')}, false) as birthing_flag,
  count(*) as n from bronze_hospital_info group by all""")
def _(c):
    birthing = F.col("meets_criteria_for_birthing_friendly_designation")
    return tally(c.bronze("hospital_info"), "emergency_services", birthing.alias("birthing"),
                 parse.to_flag(F.col("emergency_services")).alias("emergency_flag"),
                 parse.to_flag_or_false(birthing).alias("birthing_flag"))


@query("title_case", "B07", f"select x, {oracle.title('x')} as titled, count(*) as n from (select upper(p_name) || ' O''NEIL-' || p_type as x from part union all select c_name || ' of ' || c_mktsegment from customer) as t group by all")
def _(c):
    names = (c.table("part").select(F.concat(F.upper("p_name"), F.lit(" O'NEIL-"), "p_type").alias("x"))
             .unionByName(c.table("customer").select(F.concat("c_name", F.lit(" of "), "c_mktsegment").alias("x"))))
    return tally(names, "x", parse.title_case(F.col("x")).alias("titled"))


@query("zip_codes", "B08", f"""select x, {oracle.zip5('x')} as zip, count(*) as n from (
  select case when o_orderkey % 4 = 0 then cast(o_custkey as varchar) || '-' || cast(o_orderkey as varchar)
    when o_orderkey % 4 = 1 then 'none' when o_orderkey % 4 = 2 then 'ZIP ' || cast(o_orderkey as varchar) end as x from orders) as t group by all""")
def _(c):
    k, key, cust = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    raw = F.when(k == 0, F.concat(cust, F.lit("-"), key)).when(k == 1, "none").when(k == 2, F.concat(F.lit("ZIP "), key))
    return tally(c.table("orders").select(raw.alias("x")), "x", parse.to_zip5(F.col("x")).alias("zip"))


@query("missing_columns", "B09 H01", "select linestatus, count(*) as n, count(number_of_patients) as with_patients from (select 'O' as linestatus, null as number_of_patients from bronze_complications_deaths union all select 'F', number_of_patients from bronze_unplanned_visits) as t group by 1")
def _(c):
    wanted = ["number_of_patients", "number_of_patients_returned"]
    both = (parse.add_missing_text(c.bronze("complications_deaths"), wanted).withColumn("linestatus", F.lit("O"))
            .unionByName(parse.add_missing_text(c.bronze("unplanned_visits"), wanted).withColumn("linestatus", F.lit("F"))))
    return both.groupBy("linestatus").agg(F.count(F.lit(1)).alias("n"), F.count("number_of_patients").alias("with_patients"))


@query("ownership_groups", "B12", f"select hospital_ownership, {oracle.owner_group('hospital_ownership')} as ownership_group, count(*) as n from bronze_hospital_info group by all")
def _(c):
    return tally(c.bronze("hospital_info"), "hospital_ownership",
                 labels.ownership_group(F.col("hospital_ownership")).alias("ownership_group"))


@query("comparison_categories", "B13", f"select compared_to_national, {oracle.category('compared_to_national')} as category, count(*) as n from bronze_unplanned_visits group by all")
def _(c):
    return tally(c.bronze("unplanned_visits"), "compared_to_national",
                 labels.comparison_category(F.col("compared_to_national")).alias("category"))


@query("star_item_flags", "B14", "select hcahps_measure_id, hcahps_measure_id like '%STAR_RATING' as is_star, count(*) as n from bronze_hcahps group by all")
def _(c):
    return tally(c.bronze("hcahps"), "hcahps_measure_id", labels.is_star_item(F.col("hcahps_measure_id")).alias("is_star"))


@query("attribute_hash", "B16", f"""select c_custkey, md5(concat_ws('|', c_name, cast(c_nationkey as varchar), seg)) as joined,
  md5(concat_ws('|', coalesce(c_name, '{keys.NULL_MARK}'), coalesce(cast(c_nationkey as varchar), '{keys.NULL_MARK}'), coalesce(seg, '{keys.NULL_MARK}'))) as guarded
  from (select *, case when c_custkey % 7 = 0 then null else c_mktsegment end as seg from customer) as t""")
def _(c):
    df = c.table("customer").withColumn("seg", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")))
    names = ["c_name", "c_nationkey", "seg"]
    return df.select("c_custkey", keys.attribute_hash(names, guard_nulls=False).alias("joined"),
                     keys.attribute_hash(names).alias("guarded"))


@query("version_key", "B17", "select o_orderkey, md5(cast(o_custkey as varchar) || '|' || cast(cast(o_orderdate as date) as varchar)) as k from orders")
def _(c):
    return c.table("orders").select("o_orderkey", keys.version_key(F.col("o_custkey"), F.col("o_orderdate").cast("date")).alias("k"))


@query("rounding", "B18", """select l_returnflag, cast(sum(cast(round(l_extendedprice * l_discount, 1) as decimal(28,1))) as double) as one,
  cast(sum(cast(round(l_extendedprice * l_tax / 7, 2) as decimal(28,2))) as double) as two,
  cast(sum(cast(round((l_discount - 0.05) * l_quantity / 3, 3) as decimal(28,3))) as double) as three from lineitem group by 1""")
def _(c):
    def total(x, digits):
        return F.sum(numeric.round_half_away(x, digits).cast(f"decimal(28,{digits})")).cast("double")
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    return c.table("lineitem").groupBy("l_returnflag").agg(
        total(price * F.col("l_discount"), 1).alias("one"), total(price * tax / 7, 2).alias("two"),
        total((F.col("l_discount") - 0.05) * F.col("l_quantity") / 3, 3).alias("three"))


@query("safe_ratio", "B19", """select o_custkey, 100.0 * cast(count(*) filter (where o_orderstatus = 'F') as double) / nullif(count(*) filter (where o_orderstatus <> 'P'), 0) as pct_failed from orders group by 1""")
def _(c):
    status = F.col("o_orderstatus")
    return c.table("orders").groupBy("o_custkey").agg(
        numeric.percent(F.count_if(status == "F"), F.count_if(status != "P")).alias("pct_failed"))


@query("tiers_and_support", "B21 B22", f"""select s_suppkey, n, {oracle.tier('shown')} as tier, shown from (
  select s_suppkey, n, case when n >= 5 then round(s_acctbal / 100, 1) end as shown from (
    select s_suppkey, s_acctbal, count(l_orderkey) filter (where l_quantity > 49) as n from supplier left join lineitem on l_suppkey = s_suppkey group by 1, 2) as a) as b""")
def _(c):
    many = (c.table("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey"))
            .agg(F.count_if(F.col("l_quantity") > 49).alias("n")))
    counted = c.table("supplier").join(many, "s_suppkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    shown = labels.only_with_support(numeric.round_half_away(F.col("s_acctbal") / 100, 1), F.col("n"), 5)
    return counted.select("s_suppkey", "n", shown.alias("shown")).withColumn("tier", labels.outcome_tier(F.col("shown")))


@query("day_difference", "B24 B20", "select o_custkey, date_diff('day', max(cast(o_orderdate as date)), date '2002-01-01') as age_days from orders group by 1")
def _(c):
    newest = F.max(F.col("o_orderdate").cast("date"))
    return c.table("orders").groupBy("o_custkey").agg(
        F.date_diff(F.lit("2002-01-01").cast("date"), newest).cast("bigint").alias("age_days"))


@query("null_safe_change", "B25 F03", """select count(*) filter (where p is distinct from prev) as changed, count(*) as n, o_orderstatus from (
  select o_orderstatus, p, lag(p) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev from (
    select *, case when o_orderkey % 5 = 0 then null else o_orderpriority end as p from orders) as a) as b group by 3""")
def _(c):
    by = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    marked = (c.table("orders").withColumn("p", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")))
              .withColumn("prev", F.lag("p").over(by)))
    return marked.groupBy("o_orderstatus").agg(F.count_if(~F.col("p").eqNullSafe(F.col("prev"))).alias("changed"),
                                              F.count(F.lit(1)).alias("n"))


@query("json_details", "B26", "select event_type, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as total, count(*) as n from events group by 1")
def _(c):
    return (c.table("events").withColumn("k", F.from_json("props", "k bigint")["k"])
            .groupBy("event_type").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("n")))


@query("hash_prefix", "B27", "select substr(md5(text), 1, 12) as prefix, count(*) as n from documents group by 1")
def _(c):
    return tally(c.table("documents"), labels.hash_prefix(F.md5("text")).alias("prefix"))


@query("star_glyphs", "B28", """select r, d, coalesce(repeat('★', r) || repeat('☆', 5 - r), '—') as glyphs,
  case when d > 0 then '▲ ' || cast(d as varchar) when d < 0 then '▼ ' || cast(-d as varchar) else '' end as change, count(*) as n
  from (select case when o_orderstatus <> 'P' then cast(substr(o_orderpriority, 1, 1) as integer) end as r,
        case when o_orderstatus = 'F' then null else cast(o_orderkey % 5 - 2 as integer) end as d from orders) as t group by all""")
def _(c):
    status = F.col("o_orderstatus")
    rated = c.table("orders").select(
        F.when(status != "P", F.substring("o_orderpriority", 1, 1).cast("int")).alias("r"),
        F.when(status != "F", (F.col("o_orderkey") % 5 - 2).cast("int")).alias("d"))
    return tally(rated, "r", "d", labels.star_glyphs(F.col("r")).alias("glyphs"), labels.change_text(F.col("d")).alias("change"))


@query("rating_labels", "B29", """select coalesce(cast(r as varchar) || ' ★', 'Not rated') as label, count(*) as n
  from (select case when o_orderstatus <> 'P' then cast(substr(o_orderpriority, 1, 1) as integer) end as r from orders) as t group by 1""")
def _(c):
    r = F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1).cast("int"))
    return tally(c.table("orders"), labels.rating_label(r).alias("label"))


@query("load_time", "B30", "select l_linestatus, count(*) as n, count(*) as stamped from lineitem group by 1")
def _(c):
    return (with_load_time(c.table("lineitem")).groupBy("l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), F.count("loaded_at").alias("stamped")))


@query("parse_failures", "C04", f"select release_date, count(*) filter (where s is not null and {oracle.num('s')} is null) as failures from (select release_date, {oracle.clean('score')} as s from bronze_complications_deaths) as t group by 1")
def _(c):
    score = parse.text_or_null("score")
    return c.bronze("complications_deaths").groupBy("release_date").agg(
        lost_in_parsing(score, parse.to_double(score)).alias("failures"))


@query("catalogue_defaults", "B23 D01", """select s.measure_id, coalesce(c.lower_is_better, true) as lower_is_better, c.domain as fact_domain,
  coalesce(c.domain, 'Uncatalogued') as domain, count(*) as n from stg_measures as s left join catalog as c on c.measure_id = s.measure_id group by all""")
def _(c):
    joined = c.stg_measures.join(c.catalog, "measure_id", "left")
    return tally(joined, "measure_id", F.coalesce("lower_is_better", F.lit(True)).alias("lower_is_better"),
                 F.col("domain").alias("fact_domain"), F.coalesce("domain", F.lit("Uncatalogued")).alias("domain"))


