"""Raw feeds derived from the test tables, in the shape the package reads.

One template per feed, written once and rendered for Spark and for DuckDB, so
both sides start from the same raw text.  Suppliers act as facilities, line
items as measure rows, events as survey answers.  Every source row becomes a
feed row; a few carry defects (bad keys, unreadable numbers and dates, absent
values) for the cleaning steps to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import fixed_values as fv
from tidemark.sources.feeds import lookup_rows

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

STATES = [row[0] for row in lookup_rows(fv.STATE_REGIONS_TEXT)]
MEASURES = [row[0] for row in lookup_rows(fv.MEASURE_CATALOG_TEXT)]
COMPLICATION_IDS = [*MEASURES[:20], "NEW_MEASURE_A"]
VISIT_IDS = [*MEASURES[20:], "NEW_MEASURE_B"]
PHRASES = ["Better Than the National Rate", "No Different Than the National Rate", "Worse Than the National Rate",
           "Number of Cases Too Small", "Not Available", "Fewer Days Than Average per 100 Discharges",
           "Average Days per 100 Discharges", "More Days Than Average per 100 Discharges"]
OWNERS = ["Voluntary non-profit - Private", "Voluntary non-profit - Church", "Proprietary",
          "Government - State", "Government - Local", "Veterans Health Administration", "Department of Defense",
          "Tribal", "Physician", "Unknown", "Not Available"]
TYPES = ["Acute Care Hospitals", "Critical Access Hospitals", "Childrens"]
SURVEY_ITEMS = [*fv.STAR_ITEMS.values(), "H_HSP_RATING_STAR_RATING", *fv.PERCENT_ITEMS.values(), "H_CLEAN_HSP_A_P"]


class SparkText:
    @staticmethod
    def text(x):
        return f"cast({x} as string)"

    @staticmethod
    def div(a, b):
        return f"(({a}) div {b})"

    @staticmethod
    def commas(x):
        return f"format_number({x}, 0)"

    @staticmethod
    def day(x):
        return f"date_format({x}, 'MM/dd/yyyy')"

    @staticmethod
    def pick(values, index):
        return "element_at(array(" + ", ".join(f"'{v}'" for v in values) + f"), cast({index} as int) + 1)"

    @staticmethod
    def json_k(x):
        return f"cast(get_json_object({x}, '$.k') as bigint)"

    @staticmethod
    def week(x):
        return f"cast(cast(date_trunc('week', {x}) as date) as string)"

    @staticmethod
    def table(name):
        return "{" + name + "}"


class DuckText:
    @staticmethod
    def text(x):
        return f"cast({x} as varchar)"

    @staticmethod
    def div(a, b):
        return f"(({a}) // {b})"

    @staticmethod
    def commas(x):
        return f"format('{{:,}}', {x})"

    @staticmethod
    def day(x):
        return f"strftime({x}, '%m/%d/%Y')"

    @staticmethod
    def pick(values, index):
        return "[" + ", ".join(f"'{v}'" for v in values) + f"][cast({index} as int) + 1]"

    @staticmethod
    def json_k(x):
        return f"cast(json_extract({x}, '$.k') as bigint)"

    @staticmethod
    def week(x):
        return f"cast(cast(date_trunc('week', {x}) as date) as varchar)"

    @staticmethod
    def table(name):
        return name


def six_characters(d, key: str) -> str:
    """A whole number as six digits of base 36, enough for two thousand million keys."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    parts = [f"substr('{digits}', cast({d.div(key, 36**i)} % 36 as int) + 1, 1)" for i in range(5, -1, -1)]
    return "concat(" + ", ".join(parts) + ")"


def _lines(d) -> str:
    return f"""
select l_orderkey as ok, l_linenumber as ln, l_partkey as pk, l_suppkey as sk, l_returnflag, l_linestatus, l_shipdate,
       year(l_shipdate) as yr, cast(floor(l_extendedprice) as bigint) as w, s_nationkey as nk,
       {six_characters(d, 'l_suppkey')} as fid
from {d.table('lineitem')} left join {d.table('supplier')} on l_suppkey = s_suppkey"""


def _measures(d, status: str, ids: list[str], counts: bool) -> str:
    tenths = f"concat({d.text(d.div('w % 997', 10))}, '.', {d.text('(w % 997) % 10')})"
    low = f"concat({d.text(d.div('w % 997', 20))}, '.0')"
    high = f"concat({d.text('100 + ' + d.div('w % 997', 10))}, '.5')"
    patients = f"""{d.text('ln * 11')} as number_of_patients, {d.text('ln')} as number_of_patients_returned,""" if counts else ""
    return f"""
select case when ok % 101 = 0 then '12AB' when ok % 103 = 0 then concat('  ', fid, ' ') else fid end as facility_id,
       case when ok % 107 = 0 then 'ZZ' else {d.pick(STATES, 'nk * 2')} end as state,
       case when ok % 211 = 0 then 'Not Available' else {d.pick(ids, f'pk % {len(ids)}')} end as measure_id,
       concat('Rate ', {d.text(f'pk % {len(ids)}')}, ' of ', {d.text('yr')}) as measure_name,
       {d.pick(PHRASES, f'(ok + ln) % {len(PHRASES)}')} as compared_to_national,
       {d.commas('w')} as denominator,
       case when ok % 37 = 0 then 'Not Available' when ok % 41 = 0 then '12..4' when ok % 43 = 0 then {d.commas('w')}
            else {tenths} end as score,
       case when ok % 509 = 0 then {high} else {low} end as lower_estimate,
       case when ok % 509 = 0 then {low} else {high} end as higher_estimate,
       {patients}
       case when ok % 3 = 0 then '' else '1 - few cases' end as footnote,
       {d.day('l_shipdate')} as start_date,
       case when ok % 53 = 0 then 'not a date' when ok % 59 = 0 then '02/30/2022'
            else {d.day("l_shipdate + interval '90' day")} end as end_date,
       concat({d.text('yr')}, '-01-01') as release_date,
       cast(l_shipdate as timestamp) as _ingested_at
from ({_lines(d)}) as lines where l_linestatus = '{status}'"""


def _info(d) -> str:
    counts = ",\n       ".join(
        f"case when (sk + {i}) % 5 = 0 then 'Not Available' else {d.text(f'(n + {i}) % 9')} end as count_of_{g}_measures_{k}"
        for i, (g, k) in enumerate((g, k) for g in ("mort", "safety", "readm") for k in ("better", "no_different", "worse")))
    return f"""
select case when (sk + yr) % 11 = 0 then '12AB' else fid end as facility_id,
       case when (sk + yr) % 83 = 0 then 'Not Available' else concat('  O''NEIL OAK-RIDGE ', {d.text('sk')}, ' HOSPITAL ') end as facility_name,
       concat({d.text('sk')}, ' NORTH MAIN STREET') as address,
       concat('CITY OF NATION ', {d.text('nk')}) as citytown,
       case when (sk + yr) % 47 = 0 then 'ZZ' else {d.pick(STATES, 'nk * 2')} end as state,
       case when sk % 5 = 0 then {d.text('sk')} when sk % 5 = 1 then '95814-1234' when sk % 5 = 2 then '1234567'
            when sk % 5 = 3 then 'none' else '--' end as zip_code,
       concat('COUNTY ', {d.text('nk % 4')}) as countyparish,
       '(555) 010-0199' as telephone_number,
       {d.pick(TYPES, f'sk % {len(TYPES)}')} as hospital_type,
       {d.pick(OWNERS, f"(sk + {d.div('yr + sk', 3)}) % {len(OWNERS)}")} as hospital_ownership,
       case when sk % 4 = 0 then 'Yes' when sk % 4 = 1 then 'no' when sk % 4 = 2 then 'TRUE' else 'maybe' end as emergency_services,
       case when sk % 3 = 0 then 'Y' when sk % 3 = 1 then 'Not Available' else 'N' end as meets_criteria_for_birthing_friendly_designation,
       case when (sk + yr * (sk % 3)) % 6 = 0 then 'Not Available' when (sk + yr * (sk % 3)) % 6 = 5 then '3.7'
            else {d.text('(sk + yr * (sk % 3)) % 6')} end as hospital_overall_rating,
       case when (sk + yr) % 6 = 0 then '16' else '' end as hospital_overall_rating_footnote,
       {counts},
       concat({d.text('yr')}, '-01-01') as release_date,
       cast(shipped as timestamp) as _ingested_at
from (select sk, yr, nk, fid, l_returnflag, count(*) as n, max(l_shipdate) as shipped
      from ({_lines(d)}) as lines group by sk, yr, nk, fid, l_returnflag) as yearly"""


def _survey(d) -> str:
    item = d.pick(SURVEY_ITEMS, f"event_id % {len(SURVEY_ITEMS)}")
    return f"""
select case when event_id % 97 = 0 then '12AB' else {six_characters(d, 'user_id')} end as facility_id,
       case when event_id % 89 = 0 then 'ZZ' else {d.pick(STATES, '(user_id % 25) * 2')} end as state,
       case when event_id % 83 = 0 then '' else {item} end as hcahps_measure_id,
       concat('Question on ', event_type) as hcahps_question,
       concat('Answer ', event_type) as hcahps_answer_description,
       case when {item} like '%STAR_RATING' then {d.text('1 + cast(floor(value) as bigint) % 5')} else 'Not Applicable' end as patient_survey_star_rating,
       case when {item} like '%STAR_RATING' then 'Not Applicable' else {d.text('cast(floor(value) as bigint) % 101')} end as hcahps_answer_percent,
       case when event_type = 'error' then 'N/A' else {d.text('cast(floor(value) as bigint) % 100')} end as hcahps_linear_mean_value,
       {d.commas(f"1000 * {d.json_k('props')} + 7")} as number_of_completed_surveys,
       concat({d.text(d.json_k('props'))}, '.9') as survey_response_rate_percent,
       {d.day('ts')} as start_date, {d.day("ts + interval '30' day")} as end_date,
       {d.week('ts')} as release_date,
       cast(ts as timestamp) as _ingested_at
from {d.table('events')}"""


def feed_sql(d) -> dict[str, str]:
    return {
        "hospital_info": _info(d),
        "complications_deaths": _measures(d, "O", COMPLICATION_IDS, counts=False),
        "unplanned_visits": _measures(d, "F", VISIT_IDS, counts=True),
        "hcahps": _survey(d),
    }


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    text = feed_sql(SparkText)[feed]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
