"""Queries for what happens from one refresh to the next: model tests, merges, corrections, versions, ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import oracle
from bindings.jobs import AS_OF, CHECKS, SILVER, run_events, silver_tables
from bindings.registry import query
from tidemark import fixed_values as fv
from tidemark.plans import gate, gold, model_tests, oplog, silver
from tidemark.plans.model_tests import MODEL_TESTS, ModelTest
from tidemark.sources import lake, landing, versions
from tidemark.sources.feeds import DIM_HOSPITAL_CONTRACT, REQUIRED_COLUMNS

INFO = "hospital_info"


# --- model tests -----------------------------------------------------------------------
def models_of(c) -> dict[str, DataFrame]:
    return {"stg_hospitals": c.stg_hospitals, "stg_measure_scores": c.stg_measures, "stg_survey": c.stg_survey, "state_regions": c.regions,
            "measure_catalog": c.catalog, "dim_hospital": c.dim, "dim_hospital_history": c.history, "dim_measure": c.measures,
            "fct_measure_scores": c.facts, "fct_patient_experience": c.experience, "mart_hospital_scorecard": c.scorecard,
            "mart_state_summary": c.states}


#: Where DuckDB has each model.
RELATIONS = {"stg_hospitals": "stg_hospitals", "stg_measure_scores": "stg_measures", "stg_survey": "stg_survey", "state_regions": "regions",
             "measure_catalog": "catalog", "dim_hospital": "dim", "dim_hospital_history": "history", "dim_measure": "measures",
             "fct_measure_scores": "facts", "fct_patient_experience": "survey_wide", "mart_hospital_scorecard": "scorecard",
             "mart_state_summary": "states"}
#: Columns of the models as a faulty build would give them: valid in Spark and in DuckDB alike.
FAULTS = {
    "stg_hospitals": {"ownership_group": "upper(ownership_group)", "overall_rating": "overall_rating + 3"},
    "stg_measure_scores": {"comparison_category": "concat(comparison_category, '?')"},
    "stg_survey": {"star_rating": "star_rating + 2", "answer_percent": "answer_percent - 50"},
    "dim_hospital": {"facility_id": "case when overall_rating = 3 then null else facility_id end", "census_region": "case when overall_rating = 1 then null else census_region end",
                     "overall_rating": "cast(overall_rating as double)"},
    "dim_hospital_history": {"valid_from": "case when overall_rating = 2 then make_date(year(valid_from) - 1, 7, 1) else valid_from end",
                             "hospital_version_key": "case when overall_rating = 2 then 'same' else hospital_version_key end"},
    "fct_measure_scores": {"facility_id": "case when comparison_category = 'too_few_cases' then concat('X', facility_id) else facility_id end",
                           "diff_from_national_median": "-diff_from_national_median", "performance_percentile": "performance_percentile + 20",
                           "measure_id": "case when comparison_category = 'worse' then 'OTHER' else measure_id end"},
    "fct_patient_experience": {"release_date": "cast(null as date)"},
    "mart_hospital_scorecard": {"outcome_tier": "lower(outcome_tier)", "outcome_composite": "outcome_composite - 50",
                                "facility_id": "case when overall_rating = 4 then null else facility_id end"},
    "mart_state_summary": {"state": "case when rated_hospitals > 3 then 'CA' else state end"},
}


def _faulty(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: df.selectExpr(*[f"{FAULTS[name][n]} as {n}" if n in FAULTS.get(name, {}) else n for n in df.columns]) for name, df in models.items()}


def _relation(model: str, faulty: bool) -> str:
    changed = FAULTS.get(model, {}) if faulty else {}
    return f"(select * replace ({', '.join(f'{e} as {n}' for n, e in changed.items())}) from {RELATIONS[model]})" if changed else f"(select * from {RELATIONS[model]})"


def _offending_sql(t: ModelTest, faulty: bool) -> str:
    """How many rows, keys or groups offend, said plainly."""
    rows, first = _relation(t.model, faulty), t.columns[0] if t.columns else ""
    other = _relation(t.parent[0], faulty) if t.parent else ""
    if t.kind == "not_null":
        return f"select count(*) from {rows} as m where {first} is null"
    if t.kind == "values":
        return f"select count(*) from {rows} as m where {first} not in ({oracle.quoted(t.values)})"
    if t.kind == "range":
        return f"select count(*) from {rows} as m where {first} < {t.values[0]} or {first} > {t.values[1]}"
    if t.kind == "unique":
        known = f" where {first} is not null" if len(t.columns) == 1 else ""
        return f"select count(*) from (select 1 from {rows} as m{known} group by {', '.join(t.columns)} having count(*) > 1) as k"
    if t.kind == "relationship":
        return f"select count(*) from {rows} as m where {first} is not null and not exists (select 1 from {other} as p where p.{t.parent[1]} = m.{first})"
    if t.kind == "coverage":
        return f"select count(*) from {rows} as m full outer join {other} as p on p.{first} = m.{first} where m.{first} is null or p.{first} is null"
    if t.kind == "tiling":
        return (f"select count(*) from (select *, lead(valid_from) over (partition by {first} order by valid_from) as following from {rows} as m) as v "
                "where valid_to <= valid_from or (following is not null and valid_to is distinct from following)")
    if t.kind == "direction":
        return (f"select count(*) from (select {first} from {rows} as m where comparison_category = 'better' and {first} <> 'Uncatalogued' "
                f"group by 1 having {oracle.mean(t.columns[1], 3)} > 0) as d")
    wanted = ", ".join(f"('{f.name}', '{_DUCK[f.dataType.simpleString()]}')" for f in DIM_HOSPITAL_CONTRACT.fields)
    return (f"select count(*) from (values {wanted}) as w(name, kind) "
            f"left join (describe from {rows}) as d on d.column_name = w.name and d.column_type = w.kind where d.column_name is null")


_DUCK = {"string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "date": "DATE"}


def _graded_sql(t: ModelTest, faulty: bool) -> str:
    failed = f"when n > {t.error_above} then 'error' " if t.error_above is not None else ""
    return (f"select '{'faulty' if faulty else 'as built'}' as build, '{t.model}' as model, '{t.name}' as test, n as offending, "
            f"case {failed}when n > {t.warn_above} then 'warn' else 'pass' end as grade from ({_offending_sql(t, faulty)}) as c(n)")


@query("gold_gate", "K01 K02 K03 K04 K05 K06 K07 K08 K09 K10", " union all ".join(_graded_sql(t, faulty) for faulty in (False, True) for t in MODEL_TESTS))
def _(c):
    """Every declared model test, on the models as built and on models with faults."""
    built = models_of(c)
    return reduce(DataFrame.unionByName, [
        model_tests.run_model_tests(c.spark, models).select(F.lit(name).alias("build"), "model", "test", "offending", "grade")
        for name, models in (("as built", built), ("faulty", _faulty(built)))])


# --- history ---------------------------------------------------------------------------
@query("history_merged", "I08 I12 F02 F03 F04", "select * from history")
def _(c):
    """The history from releases that arrive in turn, one of them late: merged into what is stored, never built anew."""
    stg = c.stg_hospitals
    days = sorted(str(r[0]) for r in stg.select("release_date").distinct().collect())     # one row per release
    half, late = max(1, len(days) // 2), days[len(days) // 2 + 1] if len(days) > 3 else None

    def rows(some):
        return stg.where(F.col("release_date").isin([F.lit(d).cast("date") for d in some]))

    def stored(history, name):
        root = c.scratch(f"history-{name}")
        for part in ("closed", "latest"):
            getattr(history, part).write.parquet(f"{root}/{part}")
        return gold.History(*[c.spark.read.parquet(f"{root}/{part}") for part in ("closed", "latest")])

    kept = stored(gold.merge_releases(None, rows(days[:half])), "first")
    for day in [d for d in days[half:] if d != late]:
        merged = gold.merge_releases(kept, rows([day]))
        kept = stored(gold.History(kept.closed.unionByName(merged.closed), merged.latest), day)
    if late:
        kept = stored(gold.reopen_releases(kept, stg, [late]), "late")
    return gold.dim_hospital_history(kept.versions(stg.select("release_date")), c.regions)


# --- stored value counts ---------------------------------------------------------------
def _counts(c) -> DataFrame:
    """Value counts per release as a refresh stores them."""
    path = c.scratch("score-counts")
    gold.score_counts(c.stg_measures).write.partitionBy("release_date").parquet(path)
    return c.spark.read.schema(gold.score_counts(c.stg_measures).schema).parquet(path)


@query("benchmarks_from_counts", "I18 F05 F06 E06 E07", "select * from benchmarks")
def _(c):
    return gold.measure_benchmarks(c.facts, c.measures, _counts(c))


@query("scores_from_counts", "I10 F05 F06", "select * from benchmarked")
def _(c):
    return gold.benchmark_scores(c.stg_measures, c.catalog, _counts(c)).drop("_ingested_at", "ingested_at")


@query("quantiles_over_releases", "I18 E06 E07", """select measure_id, count(*) as scores, round(quantile_cont(score, 0.1), 3) as p10, round(quantile_cont(score, 0.25), 3) as p25,
  round(quantile_cont(score, 0.5), 3) as median, round(quantile_cont(score, 0.75), 3) as p75, round(quantile_cont(score, 0.9), 3) as p90
  from facts where score is not null group by 1""")
def _(c):
    """Quantiles over all releases together, merged from the counts of each."""
    return gold.quantiles_over(_counts(c))


# --- corrections -----------------------------------------------------------------------
CORRECTED, REJECTED = "1997-01-01", "1996-01-01"


@query("corrected_release", "A03 A05 A09 I04", f"""select release_date, cast(count(*) as bigint) as rows_out,
  cast(case when release_date = '{CORRECTED}' then 5 * count(*) else sum(overall_rating) end as bigint) as ratings, 1 + cast(release_date = '{CORRECTED}' as int) as times_done
  from silver_hospitals where release_date <> '{REJECTED}' group by 1
  union all select '{REJECTED}', 0, null, 2 from (select 1 from silver_hospitals where release_date = '{REJECTED}' limit 1) as r""")
def _(c):
    """Releases landed, two of them delivered again with other content, one of which is now rejected whole.

    Each delivery is noticed by its content sum; a third round finds nothing to do.
    """
    root = c.scratch("corrected")
    bronze = c.bronze(INFO)
    names = [n for n in bronze.columns if n not in ("release_date", "_ingested_at")]

    def landed(rows):
        lake.write_partitions(rows, f"{root}/bronze/{INFO}", ["release_date"])
        now = c.spark.read.schema(bronze.schema).parquet(f"{root}/bronze/{INFO}").select("release_date", *names)
        return landing.manifest_entry(now, "run", INFO, "bronze", "2026-01-01T00:00:00")

    def refresh(manifest):
        done = silver.refresh_silver(c.spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", datasets=[INFO], landed=manifest)
        return done[0]["releases"]

    refresh(landed(bronze))
    changed = bronze.where(F.col("release_date") == CORRECTED).withColumn("hospital_overall_rating", F.lit("5"))
    broken = bronze.where(F.col("release_date") == REJECTED).withColumn("facility_id", F.lit("12AB"))
    manifest = landed(changed.unionByName(broken))
    found = refresh(manifest) + refresh(manifest)
    if found != [REJECTED, CORRECTED]:
        raise AssertionError(f"processed again: {found}")
    log = lake.read_table(c.spark, silver.done_log(f"{root}/silver"))
    times = log.groupBy("release_date").agg(F.count(F.lit(1)).cast("int").alias("times_done"))
    rows = lake.read_table(c.spark, f"{root}/silver/hospitals").groupBy("release_date").agg(F.sum("overall_rating").alias("ratings"))
    return (silver.releases_done(c.spark, f"{root}/silver").select("release_date", "rows_out")
            .join(rows, "release_date", "left").join(times, "release_date"))


# --- versions --------------------------------------------------------------------------
EARLY = "1998-01-01"


@query("snapshot_counts", "A14 A15", f"""select 'dim_hospital' as table_name, count(*) as row_count, count(*) as listed, 0::bigint as pointed_to from dim union all
  select 'fct_measure_scores', count(*), count(*), count(distinct release_date) filter (where release_date < date '{EARLY}') from facts union all
  select 'pipeline_runs', count(*), count(*), 0 from orders""")
def _(c):
    """A second version that writes only what the first one lacks: rows as read, rows as listed, parts pointed to."""
    root = c.scratch("versions")

    def publish(version, facts):
        out = versions.Snapshot(c.spark, f"{root}/marts", version)
        wanted = {str(r[0]): "landed" for r in facts.select("release_date").distinct().collect()}       # one row per release
        stale = out.stale("fct_measure_scores", wanted)
        if out.before.schemas:
            out.keep("fct_measure_scores", sorted(set(wanted) - set(stale)))
        out.put("fct_measure_scores", facts.where(F.col("release_date").isin([F.lit(r).cast("date") for r in stale])),
                release="release_date", origins={r: wanted[r] for r in stale}, cluster="facility_id")
        out.put("dim_hospital", c.dim)
        return out.commit()

    publish("v1", c.facts.where(F.col("release_date") < F.lit(EARLY).cast("date")))
    entry = publish("v2", c.facts)
    logs = versions.publish_snapshot({"pipeline_runs": oplog.run_states(run_events(c))}, f"{root}/ops", "v2")
    opened = versions.open_snapshot(c.spark, f"{root}/marts") | versions.open_snapshot(c.spark, f"{root}/ops")
    listed = [(name, rows, sum("written=v1" in p.folder for p in e.of(name).values())) for e in (entry, logs) for name, rows in e.rows.items()]
    said = c.spark.createDataFrame(listed, "table_name string, listed bigint, pointed_to bigint")
    counts = [c.spark.sql(f"select '{name}' as table_name, count(*) as row_count from {name}") for name in opened]
    return reduce(DataFrame.unionByName, counts).join(said, "table_name")


# --- ledger ----------------------------------------------------------------------------
@query("ledger_gate", "J02 J03 J04 J05 J06 J07 J08 J09 J10 J11 J12 J13", " union all ".join(CHECKS))
def _(c):
    """The checks from a ledger in which most releases were counted in an earlier run and the others replaced."""
    tables = silver_tables(c)
    days = {name: sorted(r[0] for r in df.select("release_date").distinct().collect()) for name, df in tables.items()}   # one row per release
    recent = {name: some[-2:] for name, some in days.items()}
    faulty = {name: df.where(~F.col("release_date").isin(recent[name]) | (F.length("facility_id") > 100)) for name, df in tables.items()}
    path = c.scratch("ledger")
    gate.measure(c.spark, faulty).write.parquet(path)
    gate.measure(c.spark, tables, recent).write.mode("append").parquet(path)
    results = gate.run_checks(tables, AS_OF, ledger=gate.current_ledger(c.spark.read.parquet(path)))
    return results.select("dataset", "check_name", "severity", "passed", "observed")


_LACKS = {"hospitals": "state", "measure_scores": "score", "hcahps": "answer_percent"}


@query("schema_differences", "H04 J01", " union all ".join(
    f"""select '{t}' as dataset, count(*) filter (where d.column_name is null) = 0 as passed, coalesce(string_agg(w.name, ',' order by w.name) filter (where d.column_name is null), 'ok') as observed
  from (values {', '.join(f"('{n}')" for n in names)}) as w(name) left join (describe select * exclude ({_LACKS[t]}) from {SILVER[t]}) as d on d.column_name = w.name"""
    for t, names in REQUIRED_COLUMNS.items()))
def _(c):
    """Tables that each lack a column: its name, and the checks that needed it did not run."""
    tables = {t: df.drop(_LACKS[t]) for t, df in silver_tables(c).items()}
    return gate.schema_checks(tables).select("dataset", "passed", "observed")


@query("orphan_grades", "K04 D11", f"""select count(*) as offending, case when count(*) > {fv.ORPHAN_ERROR_ROWS} then 'error' when count(*) > 0 then 'warn' else 'pass' end as grade
  from facts where facility_id not in (select facility_id from history)""")
def _(c):
    test = next(t for t in MODEL_TESTS if t.kind == "relationship" and t.columns == ("facility_id",))
    return model_tests.run_model_tests(c.spark, models_of(c), [test]).select("offending", "grade")
