"""DuckDB formulations of the models, as named common table expressions.

``query(select)`` puts the expressions a statement refers to in front of it.
They state what a model means (windows over whole groups, built-in quantiles),
not how the package computes it.
"""

from __future__ import annotations

import re

from bindings.feeds import DuckText, feed_sql
from tidemark import fixed_values as fv
from tidemark.plans.gold import TRACKED
from tidemark.sources.feeds import lookup_rows


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def values_table(text: str, header: list[str]) -> str:
    rows = ", ".join(f"({quoted(r)})" for r in lookup_rows(text))
    return f"select * from (values {rows}) as t({', '.join(header)})"


STATES = quoted(r[0] for r in lookup_rows(fv.STATE_REGIONS_TEXT))
RATED = quoted(fv.RATED_CATEGORIES)


def clean(c: str) -> str:
    return f"case when trim({c}) in ({quoted(fv.NULL_WORDS)}) then null else trim({c}) end"


def num(c: str) -> str:
    return f"try_cast(replace({c}, ',', '') as double)"


def whole(c: str) -> str:
    return f"try_cast(trunc({num(c)}) as integer)"


def day(c: str) -> str:
    return (f"case when regexp_matches({c}, '^[0-9][0-9]/[0-9][0-9]/[0-9][0-9][0-9][0-9]$') "
            f"then cast(try_strptime({c}, '%m/%d/%Y') as date) end")


def flag(c: str) -> str:
    return f"case when upper({c}) in ('YES', 'Y', 'TRUE') then true when upper({c}) in ('NO', 'N', 'FALSE') then false end"


def title(c: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({c}), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"


def zip5(c: str) -> str:
    return f"lpad(regexp_extract({c}, '[0-9]+'), 5, '0')"


def category(c: str) -> str:
    return f"""case when lower({c}) like 'better%' or lower({c}) like 'fewer%' then 'better'
  when lower({c}) like 'worse%' or lower({c}) like 'more%' then 'worse'
  when lower({c}) like 'no different%' or lower({c}) like 'average%' then 'no_different'
  when lower({c}) like '%too small%' then 'too_few_cases' else 'not_available' end"""


def owner_group(c: str) -> str:
    return f"""case when {c} like 'Voluntary non-profit%' then 'Non-profit' when {c} = 'Proprietary' then 'For-profit'
  when {c} like 'Government%' or {c} in ({quoted(fv.GOVERNMENT_OWNERS)}) then 'Government'
  when {c} = 'Physician' then 'Physician-owned' else 'Other' end"""


def tier(c: str) -> str:
    return f"""case when {c} is null then 'Insufficient data' when {c} >= 70 then 'High performer'
  when {c} >= 55 then 'Above average' when {c} >= 45 then 'Average' when {c} >= 30 then 'Below average'
  else 'Low performer' end"""


def mean(c: str, digits: int, where: str | None = None) -> str:
    """Mean over decimals, so the order of summing cannot matter."""
    filtered = f" filter (where {where})" if where else ""
    return (f"cast(sum(cast({c} as decimal(28,{digits}))){filtered} as double) / "
            f"nullif(cast(count({c}){filtered} as double), 0)")


GRID = [f"{g}_measures_{k}" for g in ("mort", "safety", "readm") for k in ("better", "no_different", "worse")]
GEO_RULES = {"invalid_facility_id": f"regexp_matches(facility_id, '{fv.FACILITY_ID_PATTERN}')",
             "invalid_state": f"state in ({STATES})"}


def reasons(rules: dict[str, str]) -> str:
    return "concat_ws(';', " + ", ".join(f"case when coalesce({ok}, false) then null else '{n}' end"
                                         for n, ok in rules.items()) + ")"


def _cleaned(feed: str, columns: list[str], required: str, rule: str) -> str:
    rules = GEO_RULES | {rule: f"{required} is not null"}
    inner = ", ".join(f"{clean(c)} as {c}" for c in columns)
    return f"select *, {reasons(rules)} as reason from (select {inner}, release_date, _ingested_at from bronze_{feed}) as c"


def _newest(source: str, keys: list[str], columns: list[str]) -> str:
    ties = ", ".join(f"{c} asc nulls last" for c in sorted(set(columns) - set(keys)))
    return (f"select {', '.join(columns)} from (select *, row_number() over (partition by {', '.join(keys)} "
            f"order by _ingested_at desc nulls last, {ties}) as place from {source}) as p where place = 1")


FEED = feed_sql(DuckText)
INFO_TEXT = ["facility_id", "facility_name", "address", "citytown", "state", "zip_code", "countyparish", "telephone_number",
             "hospital_type", "hospital_ownership", "emergency_services",
             "meets_criteria_for_birthing_friendly_designation", "hospital_overall_rating",
             "hospital_overall_rating_footnote", *[f"count_of_{g}" for g in GRID]]
MEASURE_TEXT = ["facility_id", "state", "measure_id", "measure_name", "compared_to_national", "denominator", "score",
                "lower_estimate", "higher_estimate", "footnote", "start_date", "end_date"]
PATIENT_TEXT = ["number_of_patients", "number_of_patients_returned"]
SURVEY_TEXT = ["facility_id", "state", "hcahps_measure_id", "hcahps_question", "hcahps_answer_description",
               "patient_survey_star_rating", "hcahps_answer_percent", "hcahps_linear_mean_value",
               "number_of_completed_surveys", "survey_response_rate_percent", "start_date", "end_date"]

HOSPITAL_COLUMNS = ["facility_id", "facility_name", "address", "city", "state", "zip_code", "county", "phone",
                    "hospital_type", "ownership", "has_emergency_services", "is_birthing_friendly", "overall_rating",
                    "overall_rating_footnote", *GRID, "release_date", "_ingested_at"]
MEASURE_COLUMNS = ["facility_id", "measure_id", "measure_name", "compared_to_national", "denominator", "score",
                   "lower_estimate", "higher_estimate", "number_of_patients", "number_of_patients_returned", "footnote",
                   "period_start", "period_end", "source_dataset", "release_date", "_ingested_at"]
SURVEY_COLUMNS = ["facility_id", "measure_id", "question", "answer_description", "star_rating", "answer_percent",
                  "linear_mean_value", "completed_surveys", "response_rate_pct", "period_start", "period_end",
                  "release_date", "_ingested_at"]


def _typed_measures(feed: str, counts: bool) -> str:
    patients = ", ".join(f"{whole(c) if counts else 'cast(null as integer)'} as {c}" for c in PATIENT_TEXT)
    numbers = ", ".join(f"{num(c)} as {c}" for c in ("denominator", "score", "lower_estimate", "higher_estimate"))
    return f"""select facility_id, measure_id, measure_name, compared_to_national, {numbers}, {patients}, footnote,
 {day('start_date')} as period_start, {day('end_date')} as period_end, '{feed}' as source_dataset, release_date, _ingested_at
 from clean_{feed} where reason = ''"""


STARS = ", ".join(f"max(case when measure_id = '{i}' then star_rating end) as {n}" for n, i in fv.STAR_ITEMS.items())
PERCENTS = ", ".join(f"max(case when measure_id = '{i}' then answer_percent end) as {n}" for n, i in fv.PERCENT_ITEMS.items())
HASHED = ", ".join("coalesce(cast(overall_rating as varchar), 'NA')" if c == "overall_rating" else f"cast({c} as varchar)"
                   for c in TRACKED)

CTES = {
    "regions": values_table(fv.STATE_REGIONS_TEXT, fv.STATE_REGIONS_HEADER),
    "catalog": "select measure_id, measure_short_name, domain, cast(lower_is_better as boolean) as lower_is_better, unit from ("
               + values_table(fv.MEASURE_CATALOG_TEXT, fv.MEASURE_CATALOG_HEADER) + ") as raw_catalog",
    **{f"bronze_{name}": text for name, text in FEED.items()},
    "clean_hospital_info": _cleaned("hospital_info", INFO_TEXT, "facility_name", "missing_name"),
    "clean_complications_deaths": _cleaned("complications_deaths", MEASURE_TEXT, "measure_id", "missing_measure_id"),
    "clean_unplanned_visits": _cleaned("unplanned_visits", MEASURE_TEXT + PATIENT_TEXT, "measure_id", "missing_measure_id"),
    "clean_hcahps": _cleaned("hcahps", SURVEY_TEXT, "hcahps_measure_id", "missing_measure_id"),
    "typed_hospitals": f"""select facility_id, {title('facility_name')} as facility_name, {title('address')} as address,
 {title('citytown')} as city, state, {zip5('zip_code')} as zip_code, {title('countyparish')} as county,
 telephone_number as phone, hospital_type, hospital_ownership as ownership,
 {flag('emergency_services')} as has_emergency_services,
 coalesce({flag('meets_criteria_for_birthing_friendly_designation')}, false) as is_birthing_friendly,
 {whole('hospital_overall_rating')} as overall_rating, hospital_overall_rating_footnote as overall_rating_footnote,
 {', '.join(f"{whole('count_of_' + g)} as {g}" for g in GRID)}, release_date, _ingested_at
 from clean_hospital_info where reason = ''""",
    "typed_complications": _typed_measures("complications_deaths", counts=False),
    "typed_visits": _typed_measures("unplanned_visits", counts=True),
    "typed_survey": f"""select facility_id, hcahps_measure_id as measure_id, hcahps_question as question,
 hcahps_answer_description as answer_description, {whole('patient_survey_star_rating')} as star_rating,
 {whole('hcahps_answer_percent')} as answer_percent, {whole('hcahps_linear_mean_value')} as linear_mean_value,
 {whole('number_of_completed_surveys')} as completed_surveys, {whole('survey_response_rate_percent')} as response_rate_pct,
 {day('start_date')} as period_start, {day('end_date')} as period_end, release_date, _ingested_at
 from clean_hcahps where reason = ''""",
    "silver_hospitals": _newest("typed_hospitals", ["facility_id", "release_date"], HOSPITAL_COLUMNS),
    "silver_complications": _newest("typed_complications", ["facility_id", "measure_id", "release_date"], MEASURE_COLUMNS),
    "silver_visits": _newest("typed_visits", ["facility_id", "measure_id", "release_date"], MEASURE_COLUMNS),
    "silver_measures": "select * from silver_complications union all by name select * from silver_visits",
    "silver_survey": _newest("typed_survey", ["facility_id", "measure_id", "release_date"], SURVEY_COLUMNS),
    "stg_hospitals": f"""select * exclude (release_date, _ingested_at), {owner_group('ownership')} as ownership_group,
 cast(release_date as date) as release_date from silver_hospitals""",
    "stg_measures": f"""select * exclude (release_date, _ingested_at), {category('compared_to_national')} as comparison_category,
 cast(release_date as date) as release_date from silver_measures""",
    "stg_survey": """select * exclude (release_date, _ingested_at), measure_id like '%STAR\\_RATING' escape '\\' as is_star_measure,
 cast(release_date as date) as release_date from silver_survey""",
    # A spell is a run of a facility's releases with one digest: the number of changes up to and including a release.
    "spells": f"""select *, count(*) filter (where changed) over (partition by facility_id order by release_date) as spell from (
   select a.*, not exists (select 1 from digests as b where b.facility_id = a.facility_id and b.attr_hash = a.attr_hash
     and b.release_date = (select max(c.release_date) from digests as c where c.facility_id = a.facility_id and c.release_date < a.release_date)) as changed
   from digests as a) as compared""",
    "digests": f"select s.*, md5(concat_ws('|', {HASHED})) as attr_hash from stg_hospitals as s",
    # The first release of the feed that a facility is missing from after its last own one.
    "departures": """select o.facility_id, min(r.release_date) as left_on
 from (select facility_id, max(release_date) as stayed_until from stg_hospitals group by 1) as o
 join (select distinct release_date from stg_hospitals) as r on r.release_date > o.stayed_until group by 1""",
    "spell_spans": """select s.facility_id, s.spell, s.valid_from, coalesce(n.valid_from, d.left_on) as valid_to
 from (select facility_id, spell, min(release_date) as valid_from from spells group by 1, 2) as s
 left join (select facility_id, spell - 1 as spell, min(release_date) as valid_from from spells group by 1, 2) as n
   on n.facility_id = s.facility_id and n.spell = s.spell
 left join departures as d on d.facility_id = s.facility_id""",
    "versions": """select md5(p.facility_id || '|' || cast(p.valid_from as varchar)) as hospital_version_key,
 p.facility_id, s.facility_name, s.state, s.hospital_type, s.ownership, s.ownership_group, s.overall_rating,
 s.has_emergency_services, s.is_birthing_friendly, s.attr_hash, p.valid_from, p.valid_to, p.valid_to is null as is_current
 from spell_spans as p join spells as s on s.facility_id = p.facility_id and s.release_date = p.valid_from""",
    "history": "select v.*, r.census_region from versions as v left join regions as r on r.state = v.state",
    "survey_wide": f"""select facility_id, release_date, {STARS}, {PERCENTS}, max(completed_surveys) as completed_surveys,
 max(response_rate_pct) as response_rate_pct from stg_survey group by 1, 2""",
    "catalogued": """select s.*, coalesce(c.lower_is_better, true) as lower_is_better, c.domain, c.measure_short_name
 from stg_measures as s left join catalog as c on c.measure_id = s.measure_id""",
    # Rows per distinct rated score, then for each score how many of its peers lie below it.
    "score_counts": f"""select measure_id, release_date, score, count(*) as n from catalogued
 where score is not null and comparison_category in ({RATED}) group by 1, 2, 3""",
    "standings": """select c.measure_id, c.release_date, c.score,
 cast((select coalesce(sum(o.n), 0) from score_counts as o where o.measure_id = c.measure_id
       and o.release_date = c.release_date and o.score < c.score) as double) as below, g.peers
 from score_counts as c join (select measure_id, release_date, cast(sum(n) as double) - 1 as peers from score_counts group by 1, 2) as g
   on g.measure_id = c.measure_id and g.release_date = c.release_date""",
    "middles": f"""select measure_id, release_date, quantile_cont(score, 0.5) as national_median from catalogued
 where score is not null and comparison_category in ({RATED}) group by 1, 2""",
    "benchmarked": f"""select s.*, m.national_median, round(s.score - m.national_median, 3) as diff_from_national_median,
 round(100 * case when s.lower_is_better then 1 - t.share else t.share end, 1) as performance_percentile
 from catalogued as s
 left join (select measure_id, release_date, score, case when peers = 0 then 0.0 else below / peers end as share from standings) as t
   on t.measure_id = s.measure_id and t.release_date = s.release_date and t.score = s.score and s.comparison_category in ({RATED})
 left join middles as m on m.measure_id = t.measure_id and m.release_date = t.release_date""",
    "facts": """select facility_id, measure_id, release_date, domain, source_dataset, comparison_category,
 compared_to_national, denominator, score, lower_estimate, higher_estimate, national_median, diff_from_national_median,
 performance_percentile, period_start, period_end from benchmarked""",
    "dim": """select l.facility_id, l.facility_name, l.address, l.city, l.state, r.state_name, r.census_region, l.zip_code,
 l.county, l.hospital_type, l.ownership, l.ownership_group, l.has_emergency_services, l.is_birthing_friendly,
 l.overall_rating, l.release_date
 from stg_hospitals as l left join regions as r on r.state = l.state
 where l.release_date = (select max(release_date) from stg_hospitals)""",
    "measures": """select o.measure_id, coalesce(c.measure_short_name, o.source_measure_name) as measure_short_name,
 o.source_measure_name, coalesce(c.domain, 'Uncatalogued') as domain, coalesce(c.lower_is_better, true) as lower_is_better,
 c.unit, o.source_dataset
 from (select n.measure_id, n.source_measure_name, d.source_dataset
       from (select measure_id, max(measure_name) as source_measure_name from stg_measures as s
             where release_date = (select max(release_date) from stg_measures as t where t.measure_id = s.measure_id
                                   and t.measure_name is not null) group by 1) as n
       join (select measure_id, max(source_dataset) as source_dataset from stg_measures as s
             where release_date = (select max(release_date) from stg_measures as t where t.measure_id = s.measure_id)
             group by 1) as d on d.measure_id = n.measure_id) as o
 left join catalog as c on c.measure_id = o.measure_id""",
    # One long table (facility, metric, value) of everything a scorecard counts or averages.
    "votes": "select facility_id, domain, comparison_category, performance_percentile from facts where release_date = (select max(release_date) from facts)",
    "metrics": f"""select facility_id, 'rated' as metric, cast(count(*) as double) as value from votes where comparison_category in ({RATED}) group by 1
 union all select facility_id, comparison_category, count(*) from votes where comparison_category in ('better', 'worse') group by 1, 2
 union all select facility_id, 'points', {mean('performance_percentile', 1)} from votes group by 1
 union all select facility_id, 'in ' || domain, {mean('performance_percentile', 1)} from votes where domain is not null group by 1, domain
 union all select facility_id, 'before', arg_max(overall_rating, release_date) from stg_hospitals
   where overall_rating is not null and release_date <> (select max(release_date) from stg_hospitals) group by 1
 union all select facility_id, 'star', summary_star from newest_survey
 union all select facility_id, 'recommend', pct_definitely_recommend from newest_survey
 union all select facility_id, 'surveys', completed_surveys from newest_survey""",
    "newest_survey": "select * from survey_wide where release_date = (select max(release_date) from survey_wide)",
    "card": f"""select *, overall_rating - previous_overall_rating as rating_change, measures_better - measures_worse as net_outcome_signal from (
   select d.facility_id, d.facility_name, d.city, d.state, d.state_name, d.census_region, d.hospital_type, d.ownership,
   d.ownership_group, d.has_emergency_services, d.overall_rating, cast(m.v['before'] as integer) as previous_overall_rating,
   cast(m.v['star'] as integer) as patient_experience_star, cast(m.v['recommend'] as integer) as pct_definitely_recommend,
   cast(m.v['surveys'] as integer) as completed_surveys, cast(coalesce(m.v['rated'], 0) as bigint) as measures_rated,
   cast(coalesce(m.v['better'], 0) as bigint) as measures_better, cast(coalesce(m.v['worse'], 0) as bigint) as measures_worse,
   {', '.join(f"round(m.v['in {d}'], 1) as {n}" for n, d in fv.DOMAIN_PERCENTILES.items())},
   case when m.v['rated'] >= {fv.MIN_RATED_MEASURES} then round(m.v['points'], 1) end as outcome_composite
   from dim as d left join (select facility_id, map_from_entries(list((metric, value))) as v from metrics group by 1) as m
     on m.facility_id = d.facility_id) as assembled""",
    "scorecard": f"""select *, {tier('outcome_composite')} as outcome_tier,
 case when outcome_composite is not null then cast(rank() over (partition by state, outcome_composite is not null
   order by outcome_composite desc) as integer) end as state_rank from card""",
    "state_sums": f"""select state, state_name, census_region, list(overall_rating) as ratings, list(measures_rated) as rated,
 list(measures_better) as better, list(measures_worse) as worse, {mean('overall_rating', 0)} as mean_rating,
 {mean('patient_experience_star', 0)} as mean_star, {mean('outcome_composite', 1)} as mean_points from scorecard group by all""",
    "states": """select state, state_name, census_region, len(ratings) as hospitals, len(given) as rated_hospitals,
 round(mean_rating, 2) as avg_overall_rating, round(100.0 * cast(len(list_filter(given, lambda r: r >= 4)) as double) / nullif(len(given), 0), 1) as pct_4_or_5_star,
 round(mean_star, 2) as avg_patient_experience_star, round(mean_points, 1) as avg_outcome_composite,
 cast(list_sum(better) as bigint) as measures_better, cast(list_sum(worse) as bigint) as measures_worse,
 round(100.0 * cast(list_sum(worse) as double) / nullif(list_sum(rated), 0), 2) as pct_measures_worse
 from (select *, list_filter(ratings, lambda r: r is not null) as given from state_sums) as s""",
    "benchmarks": f"""select k.measure_id, m.measure_short_name, m.domain, m.unit, k.release_date, k.hospitals_reported,
 round(k.q[1], 3) as p10, round(k.q[2], 3) as p25, round(k.q[3], 3) as median, round(k.q[4], 3) as p75, round(k.q[5], 3) as p90,
 round(100.0 * k.verdicts['better'] / k.rated, 2) as pct_better, round(100.0 * k.verdicts['worse'] / k.rated, 2) as pct_worse
 from (select f.measure_id, f.release_date, f.hospitals_reported, f.q, v.verdicts, v.rated
   from (select measure_id, release_date, count(score) as hospitals_reported, quantile_cont(score, [0.1, 0.25, 0.5, 0.75, 0.9]) as q from facts group by 1, 2) as f
   left join (select measure_id, release_date, cast(sum(n) as double) as rated,
       map_from_entries(list((comparison_category, cast(n as double)))) as verdicts
     from (select p.measure_id, p.release_date, c.comparison_category, count(f.facility_id) as n
       from (select distinct measure_id, release_date from facts where comparison_category in ({RATED})) as p
       cross join (select unnest([{RATED}]) as comparison_category) as c
       left join facts as f on f.measure_id = p.measure_id and f.release_date = p.release_date and f.comparison_category = c.comparison_category
       group by 1, 2, 3) as n group by 1, 2) as v on v.measure_id = f.measure_id and v.release_date = f.release_date) as k
 join measures as m on m.measure_id = k.measure_id""",
    "changes": """select *, overall_rating - previous_rating as rating_change from (
   select facility_id, facility_name, state, census_region, hospital_type, ownership_group, valid_from, overall_rating,
   lag(overall_rating) over (partition by facility_id order by valid_from) as previous_rating from history) as h
 where previous_rating is not null and overall_rating is not null and overall_rating <> previous_rating""",
    "recent_scores": """select f.facility_id, f.measure_id, f.score, f.comparison_category, d.facility_name, d.state
 from facts as f join dim as d on d.facility_id = f.facility_id
 where f.release_date = (select max(release_date) from facts) and f.score is not null""",
}


def _mentions(text: str) -> set[str]:
    return {name for name in CTES if re.search(rf"\b(from|join)\s+{name}\b", text)}


def query(select: str) -> str:
    """``select`` with the expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for inner in sorted(_mentions(CTES[name])):
            visit(inner)
        ordered.append(name)

    for name in sorted(_mentions(select)):
        visit(name)
    if not ordered:
        return select
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in ordered) + "\n" + select
