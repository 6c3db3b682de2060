"""Queries for routing, newest rows, ranks, history and set operators on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.jobs import sum_sql
from bindings.registry import query
from tidemark.functions import numeric
from tidemark.functions.keys import attribute_hash, fingerprint
from tidemark.operators import history, newest, ranks, routing, shape, tests
from tidemark.operators.newest import newest_per_key

QUARTER_SQL = "cast(date_trunc('quarter', o_orderdate) as date)"
FEED_QUARTER_SQL = f"case when o_orderpriority = '1-URGENT' then least({QUARTER_SQL}, date '1998-10-01') else {QUARTER_SQL} end"


def quarter(c="o_orderdate"):
    return F.date_trunc("quarter", F.col(c)).cast("date")


LINE_TIES = "l_discount, l_extendedprice, l_linestatus, l_partkey, l_quantity, l_returnflag, l_suppkey, l_tax"
LINE_NEWEST = f"""select * exclude (place) from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc nulls last, {', '.join(t + ' asc nulls last' for t in LINE_TIES.split(', '))}) as place from lineitem) as t where place = 1"""


def newest_lines(c):
    return newest_per_key(c.table("lineitem"), ["l_orderkey", "l_linenumber"], [F.desc_nulls_last("l_shipdate")])


@query("dedupe_lines", "F01", LINE_NEWEST)
def _(c):
    return newest_lines(c)


@query("price_by_nation_latest_year", "F01 A16 E08", f"""select n_name, count(*) as n, cast(sum(cast(l_extendedprice as decimal(28,2))) as double) / count(*) as avg_price
  from (select *, year(l_shipdate) as y from ({LINE_NEWEST}) as d) as l join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
  where y = (select max(year(l_shipdate)) from lineitem) group by 1""")
def _(c):
    lines = newest_lines(c).withColumn("y", F.year("l_shipdate"))
    latest = c.table("lineitem").agg(F.max(F.year("l_shipdate"))).scalar()
    joined = (lines.where(F.col("y") == latest)
              .join(c.table("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
              .join(c.table("nation"), F.col("n_nationkey") == F.col("s_nationkey")))
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"),
                                        numeric.exact_mean(F.col("l_extendedprice"), 2).alias("avg_price"))


@query("route_customers", "C01 C02 C03", """select case when reason = '' then 'good' else 'bad' end as side, reason, count(*) as n,
  cast(sum(cast(c_acctbal as decimal(28,2))) as double) as balance from (
  select *, concat_ws(';', case when coalesce(c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD'), false) then null else 'segment' end,
    case when coalesce(regexp_matches(c_name, '^Customer#[0-9]+[02468]$'), false) then null else 'name' end,
    case when coalesce(case when c_custkey % 13 = 0 then null else c_acctbal end > 0, false) then null else 'balance' end) as reason from customer) as t group by 1, 2""")
def _(c):
    rules = {"segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"),
             "name": F.col("c_name").rlike("^Customer#[0-9]+[02468]$"),
             "balance": F.when(F.col("c_custkey") % 13 != 0, F.col("c_acctbal")) > 0}
    routed = routing.route(c.table("customer"), rules)
    both = (routed.good.withColumn("reason", F.lit("")).withColumn("side", F.lit("good"))
            .unionByName(routed.bad.withColumnRenamed(routing.REASON, "reason").withColumn("side", F.lit("bad"))))
    return both.groupBy("side", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(28,2)")).cast("double").alias("balance"))


@query("latest_release_rows", "A16", f"select * exclude (q) from (select *, {QUARTER_SQL} as q from orders) as t where q = (select max({QUARTER_SQL}) from orders)")
def _(c):
    return newest.latest_slice(c.table("orders").withColumn("q", quarter()), "q").drop("q")


@query("latest_per_feed", "A16", f"""select t.o_orderpriority, t.q, count(*) as n from (select *, {FEED_QUARTER_SQL} as q from orders) as t
  where t.q = (select max({FEED_QUARTER_SQL}) from orders as o where o.o_orderpriority = t.o_orderpriority) group by 1, 2""")
def _(c):
    late = F.least(quarter(), F.lit("1998-10-01").cast("date"))         # urgent orders stop early: their rows fall into an older release
    df = c.table("orders").withColumn("q", F.when(F.col("o_orderpriority") == "1-URGENT", late).otherwise(quarter()))
    found = newest.latest_slice_per_feed(df, "o_orderpriority", "q")
    return found.groupBy("o_orderpriority", "q").agg(F.count(F.lit(1)).alias("n"))


@query("previous_rating", "E03 B20", f"""select o_custkey, max_by(r, (d, r)) filter (where r is not null) as previous from (
  select o_custkey, cast(o_orderdate as date) as d, {QUARTER_SQL} as q, case when o_orderkey % 3 <> 0 then cast(substr(o_orderpriority, 1, 1) as integer) end as r from orders) as t
  where q < (select max({QUARTER_SQL}) from orders) group by 1""")
def _(c):
    rating = F.when(F.col("o_orderkey") % 3 != 0, F.substring("o_orderpriority", 1, 1).cast("int"))
    df = c.table("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"), quarter().alias("q"), rating.alias("r"))
    return newest.before_latest(df, "q").groupBy("o_custkey").agg(newest.value_at_newest("r", F.col("d")).alias("previous"))


@query("last_two_releases", "G01 E04", f"select {QUARTER_SQL} as q, count(*) as row_count from orders group by 1 order by 1 desc limit 2")
def _(c):
    return newest.last_releases(c.table("orders").withColumn("q", quarter()), 2, "q")


@query("volume_change", "E04 J05", f"""select coalesce(round(100.0 * cast(abs(max_by(n, q) - min_by(n, q)) as double) / nullif(min_by(n, q), 0), 2), 0) as pct
  from (select {QUARTER_SQL} as q, count(*) as n from orders group by 1 order by 1 desc limit 2) as t""")
def _(c):
    two = newest.last_releases(c.table("orders").withColumn("q", quarter()), 2, "q")
    new, old = F.max_by("row_count", "q"), F.min_by("row_count", "q")
    return two.agg(F.coalesce(numeric.round_half_away(numeric.percent(F.abs(new - old), old), 2), F.lit(0.0)).alias("pct"))


# --- ranks and quantiles ---------------------------------------------------------------
PRICE_PROBS = {"p10": 0.10, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.90}


# Prices in cents weighted by quarters have four decimals, so rounding there settles no tie.
@query("price_quantiles", "E06 E07", f"""select l_returnflag, l_linestatus, count(*) as n_total,
  {', '.join(f'round(quantile_cont(l_extendedprice, {q}), 4) as {n}' for n, q in PRICE_PROBS.items())} from lineitem group by 1, 2""")
def _(c):
    found = ranks.group_quantiles(c.table("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", PRICE_PROBS)
    return found.withColumns({n: numeric.round_half_away(F.col(n), 4) for n in PRICE_PROBS})


@query("quantity_medians", "E07 F05", "select l_suppkey, count(*) as n_total, quantile_cont(l_quantity, 0.5) as median from lineitem group by 1")
def _(c):
    return ranks.group_quantiles(c.table("lineitem"), ["l_suppkey"], "l_quantity", {"median": 0.5})


@query("price_percent_rank", "F06", """select l_linestatus, l_extendedprice, max(pr) as pr, count(*) as n_eq from (
  select l_linestatus, l_extendedprice, percent_rank() over (partition by l_linestatus order by l_extendedprice) as pr from lineitem) as t group by 1, 2""")
def _(c):
    counts = ranks.ordered_counts(c.table("lineitem"), ["l_linestatus"], "l_extendedprice")
    return counts.select("l_linestatus", "l_extendedprice", ranks.percent_rank_from_counts().alias("pr"), "n_eq")


@query("order_percentiles", "F05 F06 D03", """select o_orderkey, o_orderstatus, pr, med from (select * from orders) as o left join (
    select o_orderkey as k, percent_rank() over (partition by o_orderpriority order by o_totalprice) as pr,
    quantile_cont(o_totalprice, 0.5) over (partition by o_orderpriority) as med from orders where o_orderstatus <> 'P') as r on r.k = o.o_orderkey""")
def _(c):
    orders, groups, finished = c.table("orders"), ["o_orderpriority"], F.col("o_orderstatus") != "P"
    counts = ranks.ordered_counts(orders.where(finished), groups, "o_totalprice")
    med = ranks.quantiles_from_counts(counts, groups, "o_totalprice", {"med": 0.5}).select(*groups, "med")
    peers = counts.join(med, groups).select(*groups, "o_totalprice", "med", ranks.percent_rank_from_counts().alias("pr"))
    placed = ranks.attach_by_value(orders, peers, groups, "o_totalprice", finished, ["o_orderkey"])
    return placed.select("o_orderkey", "o_orderstatus", "pr", "med")


@query("rank_in_group", "F07", """select c_custkey, c_nationkey, case when bal is not null then
  cast(rank() over (partition by c_nationkey, bal is not null order by bal desc) as integer) end as place
  from (select *, case when c_custkey % 9 <> 0 then floor(c_acctbal / 100) end as bal from customer) as t""")
def _(c):
    df = c.table("customer").withColumn("bal", F.when(F.col("c_custkey") % 9 != 0, F.floor(F.col("c_acctbal") / 100).cast("double")))
    return ranks.descending_rank(df, ["c_nationkey"], "bal", "place", ["c_custkey"]).select("c_custkey", "c_nationkey", "place")


@query("price_histogram", "E14", """select p_type, bin, count(*) as n, min(p_retailprice) as low, max(p_retailprice) as high from (
  select p.p_type, p_retailprice, cast(least(floor((p_retailprice - lo) / (hi - lo) * 40.0), 39) as integer) + 1 as bin
  from part as p join (select p_type, min(p_retailprice) as lo, max(p_retailprice) as hi from part group by 1) as s on s.p_type = p.p_type) as t group by 1, 2""")
def _(c):
    return shape.equal_width_histogram(c.table("part"), ["p_type"], "p_retailprice", 40)


# --- history ---------------------------------------------------------------------------
# One state per customer and quarter: its last order of the quarter.
STATES_SQL = f"""select o_custkey, q, o_orderstatus, o_orderpriority, cast(substr(o_orderpriority, 1, 1) as integer) as rating from (
  select *, row_number() over (partition by o_custkey, q order by o_orderdate desc nulls last, o_orderkey asc) as place
  from (select *, {QUARTER_SQL} as q from orders) as a) as b where place = 1"""
# Runs of quarters with one digest, numbered by how often the digest changed so far; a run lasts until the next one starts
# or, for the last, until the first quarter of the table after the customer's last.
VERSIONS_SQL = f"""(with states as (select *, md5(concat_ws('|', o_orderstatus, o_orderpriority)) as attr_hash from ({STATES_SQL}) as raw),
  compared as (select a.*, not exists (select 1 from states as b where b.o_custkey = a.o_custkey and b.attr_hash = a.attr_hash
    and b.q = (select max(c.q) from states as c where c.o_custkey = a.o_custkey and c.q < a.q)) as changed from states as a),
  runs as (select *, count(*) filter (where changed) over (partition by o_custkey order by q) as run from compared),
  spans as (select o_custkey, run, min(q) as valid_from, max(q) as seen_until from runs group by 1, 2)
  select md5(cast(r.o_custkey as varchar) || '|' || cast(r.q as varchar)) as version_key, r.o_custkey, r.o_orderstatus, r.o_orderpriority, r.rating,
  r.attr_hash, r.q as valid_from, e.valid_to, e.valid_to is null as is_current
  from runs as r join (select s.o_custkey, s.valid_from, coalesce(min(f.valid_from), min(g.q)) as valid_to from spans as s
      left join spans as f on f.o_custkey = s.o_custkey and f.run = s.run + 1
      left join (select distinct q from states) as g on g.q > s.seen_until group by 1, 2) as e
    on e.o_custkey = r.o_custkey and e.valid_from = r.q)"""


def customer_states(c):
    orders = c.table("orders").withColumn("q", quarter())
    last = newest_per_key(orders, ["o_custkey", "q"], [F.desc_nulls_last("o_orderdate")], tie_columns=["o_orderkey"])
    return last.withColumn("rating", F.substring("o_orderpriority", 1, 1).cast("int"))


def customer_versions(c):
    digest = attribute_hash(["o_orderstatus", "o_orderpriority"], guard_nulls=False)
    return history.versions(customer_states(c), "o_custkey", "q", digest, ["o_orderstatus", "o_orderpriority", "rating"])


@query("customer_versions", "I08 F02 F03 F04", f"select * from {VERSIONS_SQL} as x")
def _(c):
    return customer_versions(c)


@query("customer_rating_changes", "I19 F08 C06", f"""select * from (select o_custkey, o_orderstatus, valid_from, rating, previous_rating, rating - previous_rating as rating_change from (
  select *, lag(rating) over (partition by o_custkey order by valid_from) as previous_rating from {VERSIONS_SQL} as x) as y
  where previous_rating is not null and rating is not null and rating <> previous_rating) as z""")
def _(c):
    return history.value_changes(customer_versions(c), "o_custkey", "rating", ["o_orderstatus"])


@query("customer_tiling", "K07 F09", f"""select cast(count(*) filter (where covered <> lasted) as integer) as faults from (
  select o_custkey, sum(coalesce(valid_to, date '2100-01-01') - valid_from) as covered,
  max(coalesce(valid_to, date '2100-01-01')) - min(valid_from) as lasted from {VERSIONS_SQL} as x group by 1) as c""")
def _(c):
    return tests.tiling_faults(customer_versions(c), "o_custkey").agg(F.count(F.lit(1)).cast("int").alias("faults"))


# --- sets and joins --------------------------------------------------------------------
@query("conformed_union", "A17 H02 H01", """select feed, count(*) as n, count(l_tax) as taxed, cast(sum(l_quantity) as double) as quantity from (
  select 'open' as feed, l_quantity, l_tax from lineitem where l_linestatus = 'O' union all select 'filled', l_quantity, null from lineitem where l_linestatus = 'F') as t group by 1""")
def _(c):
    lines = c.table("lineitem")
    feeds = {"open": lines.where("l_linestatus = 'O'").select("l_quantity", "l_tax"),
             "filled": lines.where("l_linestatus = 'F'").select("l_quantity")}
    return shape.conformed_union(feeds, "feed").groupBy("feed").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("taxed"), F.sum("l_quantity").alias("quantity"))


@query("pending_releases", "A09 H03", f"select distinct {QUARTER_SQL} as q from orders where {QUARTER_SQL} not in (select {QUARTER_SQL} from orders where o_orderdate < timestamp '1998-02-01')")
def _(c):
    releases = c.table("orders").select(quarter().alias("q"), "o_orderdate")
    done = releases.where(F.col("o_orderdate") < F.lit("1998-02-01").cast("timestamp_ntz"))
    return shape.not_yet_done(releases, done, ["q"])


@query("newer_than_loaded", "C09", f"select * from orders where {QUARTER_SQL} > (select max({QUARTER_SQL}) from orders where o_orderstatus = 'P' and o_orderdate < timestamp '2000-01-01')")
def _(c):
    orders = c.table("orders").withColumn("q", quarter())
    loaded = orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")))
    return shape.newer_than_loaded(orders, loaded, "q").drop("q")


@query("duplicate_lines", "J03 E10 K06", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def _(c):
    return tests.duplicate_keys(c.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_turns", "K06", "select conv_id, turn, count(*) as n from conversations group by 1, 2 having count(*) > 1")
def _(c):
    return tests.duplicate_keys(c.table("conversations"), ["conv_id", "turn"])


@query("labels_without_document", "D11 K04", "select * from labels where doc_id is not null and doc_id not in (select case when lang = 'fr' then -1 - doc_id else doc_id end from documents)")
def _(c):
    return tests.orphan_rows(c.table("labels"), "doc_id", c.table("documents").withColumn("doc_id", F.expr("case when lang = 'fr' then -1 - doc_id else doc_id end")), "doc_id")


@query("customers_without_orders", "D09 K08", """select coalesce(c.k, o.k) as k, case when c.k is null then 'left' else 'right' end as missing_from
  from (select case when c_acctbal > 0 then c_custkey else -c_custkey end as k from customer) as c full outer join (select distinct o_custkey as k from orders) as o on o.k = c.k
  where c.k is null or o.k is null""")
def _(c):
    customers = c.table("customer").select(F.expr("case when c_acctbal > 0 then c_custkey else -c_custkey end").alias("k"))
    buyers = c.table("orders").select(F.col("o_custkey").alias("k")).distinct()
    return tests.not_in_both(customers, buyers, "k")


@query("unexpected_languages", "K03", "select doc_id, lang from documents where lang not in ('en', 'fr')")
def _(c):
    return tests.unexpected_values(c.table("documents").select("doc_id", "lang"), "lang", ["en", "fr"])


@query("discount_out_of_range", "K05 J06 J12", "select l_orderkey, l_linenumber, l_discount from lineitem where l_discount < 0.01 or l_discount > 0.09")
def _(c):
    return tests.out_of_range(c.table("lineitem").select("l_orderkey", "l_linenumber", "l_discount"), "l_discount", 0.01, 0.09)


@query("event_pivot", "E02 I09", """select user_id, cast(ts as date) as d, """ + ", ".join(
    f"max(case when event_type = '{t}' then value end) as {t}_max" for t in ("click", "error", "purchase", "signup", "view")) + " from events group by 1, 2")
def _(c):
    return c.table("events").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(
        *[shape.max_for_item("event_type", t, "value").alias(f"{t}_max") for t in ("click", "error", "purchase", "signup", "view")])


@query("content_sums", "A05", f"select o_orderpriority, count(*) as row_count, {sum_sql(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate'])} as content_sum from orders group by 1")
def _(c):
    return fingerprint(c.table("orders"), ["o_orderpriority"])
