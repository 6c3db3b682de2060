"""Queries for landing, incremental jobs, checks, snapshots and operational logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bindings import oracle
from bindings.feeds import STATES
from bindings.registry import query
from tidemark.plans import gate, oplog, serving, silver
from tidemark.sources import lake, landing, versions
from tidemark.sources.feeds import FEEDS, REGION_SCHEMA, REQUIRED_COLUMNS, read_lookup_csv
from tidemark.streaming.pickup import pick_up

AS_OF = "2001-06-30"
INFO, SURVEY = "hospital_info", "hcahps"


# --- landing ---------------------------------------------------------------------------
# Customers arrive in pages of at most 20 keys per nation; one page in each tenth nation is empty.
PAGE = "c_custkey // 500"
PAGE_ROWS = f"""select c_nationkey as feed, {PAGE} as page, c_custkey, c_name from customer"""


def customer_pages(c):
    page = F.floor(F.col("c_custkey") / 500)
    record = F.struct(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
    pages = (c.table("customer").groupBy(F.col("c_nationkey").alias("feed"), page.alias("page"))
             .agg(F.collect_list(record).alias("results")))           # at most 500 keys per page
    totals = c.table("customer").groupBy(F.col("c_nationkey").alias("feed")).agg(F.count(F.lit(1)).alias("count"))
    emptied = F.when((F.col("feed") % 10 == 0) & (F.col("page") == 1), F.slice("results", 1, 0)).otherwise(F.col("results"))
    return pages.join(totals, "feed").select("feed", (F.col("page") * 500).alias("offset"), "count", emptied.alias("results"))


@query("land_pages", "A01", f"select feed, cast(c_custkey as varchar) as c_custkey, c_name from ({PAGE_ROWS}) as t where not (feed % 10 = 0 and page >= 1)")
def _(c):
    return landing.land_pages(customer_pages(c), ["feed"])


@query("page_totals", "A01", f"""select feed, cast(count(*) filter (where not (feed % 10 = 0 and page >= 1)) as bigint) as rows_landed, count(*) as rows_announced,
  count(*) filter (where not (feed % 10 = 0 and page >= 1)) = count(*) as is_complete from ({PAGE_ROWS}) as t group by 1""")
def _(c):
    return landing.page_totals(customer_pages(c), ["feed"])


@query("release_identity", "A02", "select case when o_orderkey % 7 = 0 then '2026-01-01' else substr(cast(o_orderdate as varchar), 1, 10) end as release_date, count(*) as n from orders group by 1")
def _(c):
    modified = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_orderdate").cast("string"))
    day = landing.release_of(modified, F.lit("2026-01-01"))
    return c.table("orders").groupBy(day.alias("release_date")).agg(F.count(F.lit(1)).alias("n"))


MANIFEST_LOG = """select concat('run', cast(o_orderkey as varchar)) as run_id, o_orderpriority as dataset,
  cast(cast(date_trunc('quarter', o_orderdate) as date) as varchar) as release_date, cast(o_custkey as bigint) as rows,
  md5(cast(o_orderkey as varchar)) as content_sum, cast(o_orderdate as timestamp) as ingested_at from orders"""
MANIFEST_NOW = f"""select dataset, release_date, max_by(rows, (ingested_at, content_sum)) as rows,
  max_by(content_sum, (ingested_at, content_sum)) as content_sum, max(ingested_at) as ingested_at from ({MANIFEST_LOG}) as t group by 1, 2"""


def manifest_log(c):
    """Every order re-lands its quarter's feed: an append-only log with many entries per key."""
    return c.table("orders").select(
        F.col("o_orderpriority").alias("dataset"),
        F.date_trunc("quarter", "o_orderdate").cast("date").cast("string").alias("release_date"),
        F.md5(F.col("o_orderkey").cast("string")).alias("content_sum"),
        F.col("o_custkey").alias("rows"), F.col("o_orderdate").cast("timestamp").alias("ingested_at"))


@query("manifest_now", "A18 M04", f"select dataset, release_date, rows, content_sum, cast(ingested_at as date) as ingested_on from ({MANIFEST_NOW}) as t")
def _(c):
    now = landing.current_manifest(manifest_log(c))
    return now.select("dataset", "release_date", "rows", "content_sum", F.col("ingested_at").cast("date").alias("ingested_on"))


@query("new_releases", "A03", f"select dataset, release_date from ({MANIFEST_NOW}) as t where release_date >= '1999-01-01' or dataset = '5-LOW'")
def _(c):
    now = landing.current_manifest(manifest_log(c)).select("dataset", "release_date", "content_sum")
    landed = now.where((F.col("release_date") < "1999-01-01") & (F.col("dataset") != "5-LOW"))
    return landing.new_releases(now, landed).select("dataset", "release_date")


@query("bronze_columns", "A04 H01", """select cast(o_custkey as varchar) as o_custkey, cast(o_orderkey as varchar) as o_orderkey, o_orderpriority, o_orderstatus,
  'run-1' as _run_id, 'files' as _source, '2026-01-01T00:00:00' as _ingested_at, cast(cast(date_trunc('quarter', o_orderdate) as date) as varchar) as _release_date from orders""")
def _(c):
    orders = c.table("orders")
    release = F.date_trunc("quarter", "o_orderdate").cast("date")
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", release.alias("q"))
    return landing.to_bronze(rows, "run-1", F.col("q"), "files", "2026-01-01T00:00:00").drop("q")


@query("bronze_round_trip", "A06 A07 A08 A12", f"""select release_date, count(*) as n, count(distinct hospital_overall_rating) as ratings from bronze_{INFO}
  where release_date in ('1996-01-01', '1999-01-01') group by 1""")
def _(c):
    path = f"{c.scratch('round-trip')}"
    bronze = landing.refuse_empty(c.bronze(INFO), INFO)
    lake.write_partitions(bronze, path, ["release_date"])
    back = lake.read_releases(c.spark, path, ["1996-01-01", "1999-01-01"])
    return back.groupBy("release_date").agg(F.count(F.lit(1)).alias("n"),
                                            F.countDistinct("hospital_overall_rating").alias("ratings"))


def sum_sql(columns) -> str:
    """The content sum over text columns, as DuckDB says it."""
    parts = ", ".join(f"coalesce('=' || cast({n} as varchar), '␀')" for n in sorted(columns))
    return f"cast(sum(cast(('0x' || substr(sha256(concat_ws('␟', {parts})), 1, 15)) as bigint)) as varchar)"


@query("landed_manifest", "A05 A07 M04", f"select release_date, '{INFO}' as dataset, count(*) as rows, {sum_sql(oracle.INFO_TEXT)} as content_sum from bronze_{INFO} group by 1")
def _(c):
    rows = c.bronze(INFO).drop("_ingested_at")
    path = landing.land_release(rows.where("release_date = '1996-01-01'").drop("release_date"), c.scratch("landed"), INFO, "1996-01-01")
    lake.write_partitions(rows.where("release_date <> '1996-01-01'"), path, ["release_date"])
    back = lake.read_table(c.spark, path)
    return landing.manifest_entry(back, "run-1", INFO, "bronze", "2026-01-01T00:00:00").select("release_date", "dataset", "rows", "content_sum")


@query("lookup_from_csv", "A13 D02", """select r.census_region, r.census_division, count(*) as suppliers from supplier
  join (select *, row_number() over () as i from regions) as r on r.i = s_nationkey * 2 + 1 group by 1, 2""")
def _(c):
    path = c.scratch("lookup")
    c.regions.coalesce(1).write.option("header", True).csv(path)
    regions = read_lookup_csv(c.spark, path, REGION_SCHEMA)
    state = F.element_at(F.split(F.lit(",".join(STATES)), ","), F.col("s_nationkey") * 2 + 1)
    joined = c.table("supplier").withColumn("state", state).join(regions, "state", "left")
    return joined.groupBy("census_region", "census_division").agg(F.count(F.lit(1)).alias("suppliers"))


# --- incremental silver ----------------------------------------------------------------
@query("incremental_silver", "I04 A08 A09 A10 A11", f"""select case when release_date < '1998-01-01' then 1 else 2 end as round, count(*) as rows_in,
  count(*) filter (where reason <> '') as quarantined,
  (select count(*) from silver_hospitals as s where (s.release_date < '1998-01-01') = (case when c.release_date < '1998-01-01' then 1 else 2 end = 1)) as rows_out,
  count(distinct release_date) as releases from clean_{INFO} as c group by 1, 4""")
def _(c):
    root = c.scratch("incremental")
    bronze = c.bronze(INFO)
    for early in (True, False):
        part = bronze.where((F.col("release_date") < "1998-01-01") == F.lit(early))
        lake.write_partitions(part, f"{root}/bronze/{INFO}", ["release_date"])
        silver.refresh_silver(c.spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", datasets=[INFO])
    log = lake.read_table(c.spark, silver.done_log(f"{root}/silver"))          # an entry for each time a release was processed
    return log.withColumn("round", F.dense_rank().over(Window.orderBy("done_at"))).groupBy("round").agg(
        *[F.sum(n).alias(n) for n in ("rows_in", "quarantined", "rows_out")], F.count(F.lit(1)).alias("releases"))


@query("quarantine_rows", "A11", f"select release_date, reason as _reject_reason, count(*) as n from clean_{INFO} where reason <> '' group by 1, 2")
def _(c):
    path = c.scratch("quarantine")
    parts = silver.silver_parts(c.bronze(INFO), INFO)
    releases = [r[0] for r in c.bronze(INFO).select("release_date").distinct().collect()]   # one row per release
    lake.replace_quarantine(parts.bad, path, releases)
    return lake.read_quarantine(c.spark, path).groupBy("release_date", "_reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("stream_pickup", "A09 A10", "select * exclude (_ingested_at) from silver_survey")
def _(c):
    root = c.scratch("stream")
    lake.write_partitions(c.bronze(SURVEY), f"{root}/bronze/{SURVEY}", ["release_date"])
    pick_up(c.spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", SURVEY, f"{root}/state").awaitTermination()
    return lake.read_table(c.spark, f"{root}/silver/hcahps").drop("_ingested_at")


# --- checks ----------------------------------------------------------------------------
KEYS = {"hospitals": "facility_id, release_date", "measure_scores": "facility_id, measure_id, release_date",
        "hcahps": "facility_id, measure_id, release_date"}
SILVER = {"hospitals": "silver_hospitals", "measure_scores": "silver_measures", "hcahps": "silver_survey"}


#: What is counted of each table by release, and the limits on these numbers; ``newest`` and ``before`` are the last two releases.
_COUNTED = {
    "hospitals": {"odd": "overall_rating not between 1 and 5", "unrated": "overall_rating is null"},
    "measure_scores": {"odd": "lower_estimate > higher_estimate", "unread": "score is null and compared_to_national ilike '%national%'",
                       "strays": "(facility_id, release_date) not in (select (facility_id, release_date) from silver_hospitals)"},
    "hcahps": {"odd": "star_rating not between 1 and 5", "beyond": "answer_percent not between 0 and 100"},
}
_LIMITS = {
    "row_count_positive": ("error", "any_value(r.n)", "> 0"),
    "business_key_unique": ("error", "any_value(twice)", "= 0"),
    "facility_id_not_null": ("error", "sum(b.nameless)", "= 0"),
    "release_volume_change_pct": ("error", "round(100.0 * abs(any_value(r.n) - any_value(r.before)) / any_value(r.before), 2)", "<= 25"),
}
_OWN_LIMITS = {
    "hospitals": {"overall_rating_in_range": ("error", "sum(b.odd)", "= 0"), "overall_rating_null_pct": ("warn", "round(100.0 * any_value(r.unrated) / any_value(r.n), 2)", "<= 60"),
                  "freshness_days": ("warn", f"any_value(date_diff('day', cast(r.release_date as date), date '{AS_OF}'))", "<= 200")},
    "measure_scores": {"ci_bounds_ordered": ("error", "sum(b.odd)", "= 0"), "unparseable_score_count": ("warn", "sum(b.unread)", "<= 5"),
                       "orphan_facility_pct": ("warn", "round(100.0 * any_value(r.strays) / any_value(r.n), 3)", "<= 1")},
    "hcahps": {"star_rating_in_range": ("error", "sum(b.odd)", "= 0"), "answer_percent_in_range": ("error", "sum(b.beyond)", "= 0")},
}


def _table_checks(t: str) -> str:
    """All checks of a table, from one table of counts by release."""
    counted = ", ".join(f"cast(count(*) filter (where {rule}) as double) as {name}" for name, rule in _COUNTED[t].items())
    limits = _LIMITS | _OWN_LIMITS[t]
    seen = ", ".join(f"cast(coalesce({value}, 0) as decimal(24,3)) as {name}" for name, (_, value, _) in limits.items())
    wide = (f"select {seen} from (select *, lag(n) over (order by release_date) as before from (select release_date, cast(count(*) as double) as n, count(*) filter (where facility_id is null) as nameless, "
            f"{counted} from {SILVER[t]} group by 1) as a) as b join (select * from (select *, lag(n) over (order by release_date) as before from (select release_date, cast(count(*) as double) as n, "
            f"{counted} from {SILVER[t]} group by 1) as x) as y order by release_date desc limit 1) as r on true "
            f"cross join (select count(*) as twice from (select {KEYS[t]} from {SILVER[t]} group by all having count(*) > 1) as d) as k")
    said = " ".join(f"when '{name}' then v {test}" for name, (_, _, test) in limits.items())
    grade = " ".join(f"when '{name}' then '{severity}'" for name, (severity, _, _) in limits.items())
    return (f"select '{t}' as dataset, check_name, case check_name {grade} end as severity, case check_name {said} end as passed, cast(v as varchar) as observed "
            f"from (unpivot ({wide}) on * into name check_name value v) as u")


def _contract(t: str) -> str:
    wanted = ", ".join(f"('{n}')" for n in REQUIRED_COLUMNS[t])
    return (f"select '{t}' as dataset, 'schema_contract' as check_name, 'error' as severity, count(*) filter (where d.column_name is null) = 0 as passed, "
            f"coalesce(string_agg(w.name, ',' order by w.name) filter (where d.column_name is null), 'ok') as observed "
            f"from (values {wanted}) as w(name) left join (describe from {SILVER[t]}) as d on d.column_name = w.name")


CHECKS = [q for t in SILVER for q in (_contract(t), _table_checks(t))]


def silver_tables(c):
    return {"hospitals": c.hospitals, "measure_scores": c.measure_scores, "hcahps": c.hcahps}


@query("silver_gate", "J01 J02 J03 J04 J05 J06 J07 J08 J09 J10 J11 J12 J13 D10", " union all ".join(CHECKS))
def _(c):
    tables = silver_tables(c)
    with c.dealt(*FEEDS):
        results = gate.run_checks(tables, AS_OF)
    return results.select("dataset", "check_name", "severity", "passed", "observed")


@query("blocking_checks", "J15", " union all ".join(f"select dataset, check_name from ({x}) as c where severity = 'error' and not passed" for x in CHECKS))
def _(c):
    tables = silver_tables(c)
    with c.dealt(*FEEDS):                                              # keys of all rows are counted here
        return gate.failed_errors(gate.run_checks(tables, AS_OF)).select("dataset", "check_name")


_RATES = " union all ".join(f"select '{FEEDS[f].table}<-{f}' as dataset, count(*) as rows_in, count(*) filter (where reason <> '') as q from clean_{f}" for f in FEEDS)


@query("quarantine_rates", "J14", f"""select dataset, case when pct > 5 then 'error' else 'warn' end as severity, pct <= 1 as passed, cast(cast(pct as decimal(24,3)) as varchar) as observed
  from (select dataset, round(100.0 * cast(q as double) / rows_in, 3) as pct from ({_RATES}) as r) as t""")
def _(c):
    parts = [silver.silver_parts(c.bronze(f), f).stats.select(
        F.lit(f"{FEEDS[f].table}<-{f}").alias("table"), "rows_in", "quarantined", F.lit(0).cast("bigint").alias("duplicates_removed"))
        for f in FEEDS]
    return gate.quarantine_rates(reduce(DataFrame.unionByName, parts)).select("dataset", "severity", "passed", "observed")


# --- logs ------------------------------------------------------------------------------
# Orders as runs: started on the order day, P still running, F failed, O succeeded some time later.
RUN_STATES = """select cast(o_orderkey as varchar) as run_id, o_orderpriority as source, cast(o_orderdate as timestamp) as started_at,
  case when o_orderstatus <> 'P' then cast(o_orderdate as timestamp) + to_seconds(o_custkey % 1000) end as finished_at,
  case o_orderstatus when 'P' then 'running' when 'F' then 'failed' else 'success' end as status,
  case when o_orderstatus = 'F' then 'stopped' end as error from orders"""


def run_events(c):
    start = F.col("o_orderdate").cast("timestamp")
    end = F.timestamp_seconds(F.unix_seconds(start) + F.col("o_custkey") % 1000)
    base = [F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("source"),
            F.lit("scheduled").alias("trigger")]
    none = F.lit(None).cast("string").alias("error")
    begun = c.table("orders").select(*base, F.lit("running").alias("status"), start.alias("event_time"), none)
    ended = c.table("orders").where("o_orderstatus <> 'P'").select(
        *base, F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"),
        end.alias("event_time"), F.when(F.col("o_orderstatus") == "F", "stopped").alias("error"))
    return begun.unionByName(ended)


@query("run_states", "M01", f"select run_id, source, started_at, finished_at, status, error from ({RUN_STATES}) as t")
def _(c):
    return oplog.run_states(run_events(c)).drop("trigger").withColumns(
        {n: F.col(n).cast("timestamp_ntz") for n in ("started_at", "finished_at")})


@query("abandoned_runs", "M03", f"select status, count(*) as n from (select case status when 'running' then 'failed' else status end as status from ({RUN_STATES}) as t) as u group by 1")
def _(c):
    events = run_events(c)
    closed = events.unionByName(oplog.close_abandoned(events, F.lit("2002-01-01 00:00:00")))
    return oplog.run_states(closed).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("run_history", "L14 G04", f"""select run_id, source, 'scheduled' as trigger, status, cast(date_diff('second', started_at, finished_at) as double) as duration_s, error
  from ({RUN_STATES}) as t order by started_at desc, run_id limit 15""")
def _(c):
    return serving.run_history(oplog.run_states(run_events(c))).drop("started_at")


@query("last_success", "L19 G04", f"select run_id, source from ({RUN_STATES}) as t where status = 'success' order by finished_at desc, run_id limit 1")
def _(c):
    return serving.last_success(oplog.run_states(run_events(c))).select("run_id", "source")


# Line items as tasks of their order, with details that report one table each.
def task_log(c):
    details = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("table<-"), F.col("l_returnflag"), F.col("l_linestatus")).alias("table"),
        F.col("l_orderkey").alias("rows_in"), (F.col("l_partkey") % 50).alias("rows_out"),
        (F.col("l_suppkey") % 7).alias("quarantined"), F.lit(1).cast("bigint").alias("duplicates_removed"),
        F.lit(0).cast("bigint").alias("unparseable_numerics"))).alias("tables")))
    return c.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "silver").otherwise("publish").alias("task"),
        F.col("l_shipdate").cast("timestamp").alias("started_at"), F.lit("success").alias("status"),
        F.col("l_quantity").alias("duration_s"), details.alias("details"))


@query("task_durations", "L15 M02", """select cast(l_orderkey as varchar) as run_id, case when l_linenumber % 2 = 0 then 'silver' else 'publish' end as task, l_quantity as duration_s,
  cast(sum(cast(l_quantity as decimal(28,3))) over (partition by l_orderkey) as double) as run_s from lineitem""")
def _(c):
    return serving.task_durations(task_log(c)).drop("status")


LAYER_TASKS = """select 'table<-' || l_returnflag || l_linestatus as t, l_shipdate, l_orderkey as rows_in, l_partkey % 50 as rows_out, l_suppkey % 7 as quarantined
  from lineitem where l_linenumber % 2 = 0 and l_partkey % 50 <> 0"""
LAYER_NOW = f"""select t as "table", rows_in, rows_out, quarantined from (select *, row_number() over (partition by t order by l_shipdate desc, rows_in desc, rows_out desc, quarantined desc) as place
  from ({LAYER_TASKS}) as a) as b where place = 1"""


@query("task_tables", "B26 L18", LAYER_NOW)
def _(c):
    return oplog.task_tables(task_log(c), "silver").select("table", "rows_in", "rows_out", "quarantined")


@query("layer_totals", "L18 E13", f"""select 'bronze' as layer, cast(sum(rows) as bigint) as rows, 0::bigint as duplicates_removed, 0::bigint as quarantined from ({MANIFEST_NOW}) as m
  union all select 'silver', cast(sum(rows_out) as bigint), count(*), cast(sum(quarantined) as bigint) from ({LAYER_NOW}) as s
  union all select 'gold', (select count(*) from orders) + (select count(*) from customer), 0, 0""")
def _(c):
    folder = c.scratch("layers")
    versions.publish_snapshot({t: c.table(t) for t in ("orders", "customer")}, folder, "v1")
    return serving.layer_totals(landing.current_manifest(manifest_log(c)), oplog.task_tables(task_log(c), "silver"), versions.published(c.spark, folder))


@query("bronze_volume", "L17 E13", f"select release_date, cast(sum(rows) as bigint) as rows from ({MANIFEST_NOW}) as m group by 1")
def _(c):
    return serving.bronze_volume(landing.current_manifest(manifest_log(c)))


@query("manifest_list", "L17 B27", f"select dataset, release_date, rows, substr(content_sum, 1, 12) as content from ({MANIFEST_NOW}) as m")
def _(c):
    return serving.manifest_list(landing.current_manifest(manifest_log(c))).drop("ingested_at")


# Customers' orders as check results of a run per quarter.
CHECK_LOG = """select cast(cast(date_trunc('quarter', o_orderdate) as date) as varchar) as run_id, o_orderpriority as dataset, cast(o_orderkey as varchar) as check_name,
  case when o_custkey % 3 = 0 then 'error' else 'warn' end as severity, o_orderstatus = 'O' as passed from orders"""


def check_log(c):
    return c.table("orders").select(
        F.date_trunc("quarter", "o_orderdate").cast("date").cast("string").alias("run_id"),
        F.date_trunc("quarter", "o_orderdate").cast("timestamp").alias("checked_at"),
        F.col("o_orderpriority").alias("dataset"), F.col("o_orderkey").cast("string").alias("check_name"),
        F.when(F.col("o_custkey") % 3 == 0, "error").otherwise("warn").alias("severity"),
        (F.col("o_orderstatus") == "O").alias("passed"), F.lit("0").alias("observed"), F.lit("= 0").alias("threshold"),
        F.lit("").alias("message"))


@query("check_summary", "L16 J16", f"""select count(*) filter (where passed) as passed, count(*) filter (where not passed and severity = 'warn') as warnings,
  count(*) filter (where not passed and severity = 'error') as blocking, count(*) as checks from ({CHECK_LOG}) as t where run_id = (select max(run_id) from ({CHECK_LOG}) as u)""")
def _(c):
    return serving.check_summary(oplog.latest_check_results(check_log(c)))


@query("check_list", "L16 G05", f"""select case when passed then 'pass' when severity = 'warn' then 'warn' else 'fail' end as result, dataset, check_name, severity, '0' as observed, '= 0' as threshold, '' as message
  from ({CHECK_LOG}) as t where run_id = (select max(run_id) from ({CHECK_LOG}) as u)""")
def _(c):
    return serving.check_list(oplog.latest_check_results(check_log(c)))


