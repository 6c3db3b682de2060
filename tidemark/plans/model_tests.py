"""Tests of the models between building and publishing them, declared as a list.

All tests of a model that judge single rows are counted in one pass over it; a
key, a relationship or a rule between rows takes one shuffle of the columns it
needs.  A test that cannot run is a failed test and leaves the others alone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fv
from tidemark.operators import tests
from tidemark.session import together
from tidemark.sources.feeds import DIM_HOSPITAL_CONTRACT


class ModelTestError(RuntimeError):
    """A model test ended with ``error``."""


@dataclass(frozen=True)
class ModelTest:
    """One test: what it counts in which model, and how many offending rows are too many.

    More than ``warn_above`` rows warn, more than ``error_above`` fail; without the
    latter a test only warns.
    """

    model: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()                                  # accepted values, or the least and the greatest
    parent: tuple[str, str] | None = None               # model and column that a relationship refers to
    warn_above: int = 0
    error_above: int | None = 0

    @property
    def name(self) -> str:
        return "_".join((self.kind, *self.columns))


def _each(model: str, kind: str, *columns: str, **more) -> list[ModelTest]:
    return [ModelTest(model, kind, (c,), **more) for c in columns]


MODEL_TESTS: tuple[ModelTest, ...] = (
    *_each("stg_hospitals", "not_null", "facility_id"),
    ModelTest("stg_hospitals", "relationship", ("state",), parent=("state_regions", "state")),
    ModelTest("stg_hospitals", "range", ("overall_rating",), (1, 5)),
    ModelTest("stg_hospitals", "values", ("ownership_group",), fv.OWNERSHIP_GROUPS),
    ModelTest("stg_measure_scores", "values", ("comparison_category",), fv.COMPARISON_CATEGORIES),
    *_each("stg_measure_scores", "not_null", "measure_id"),
    ModelTest("stg_measure_scores", "relationship", ("measure_id",), parent=("measure_catalog", "measure_id"), error_above=None),
    ModelTest("stg_survey", "range", ("star_rating",), (1, 5)),
    ModelTest("stg_survey", "range", ("answer_percent",), (0, 100)),
    ModelTest("dim_hospital", "contract", values=tuple(DIM_HOSPITAL_CONTRACT.fields)),
    *_each("dim_hospital", "unique", "facility_id"),
    *_each("dim_hospital", "not_null", "facility_id", "facility_name", "state", "census_region"),
    *_each("dim_hospital_history", "unique", "hospital_version_key"),
    *_each("dim_hospital_history", "not_null", "hospital_version_key"),
    ModelTest("dim_hospital_history", "tiling", ("facility_id",)),
    *_each("dim_measure", "unique", "measure_id"),
    *_each("dim_measure", "not_null", "measure_id"),
    ModelTest("fct_measure_scores", "unique", ("facility_id", "measure_id", "release_date")),
    *_each("fct_measure_scores", "not_null", "facility_id"),
    ModelTest("fct_measure_scores", "relationship", ("facility_id",), parent=("dim_hospital_history", "facility_id"),
              error_above=fv.ORPHAN_ERROR_ROWS),
    ModelTest("fct_measure_scores", "relationship", ("measure_id",), parent=("dim_measure", "measure_id")),
    ModelTest("fct_measure_scores", "range", ("performance_percentile",), (0, 100)),
    ModelTest("fct_measure_scores", "direction", ("domain", "diff_from_national_median")),
    ModelTest("fct_patient_experience", "unique", ("facility_id", "release_date")),
    *_each("mart_hospital_scorecard", "unique", "facility_id"),
    *_each("mart_hospital_scorecard", "not_null", "facility_id"),
    ModelTest("mart_hospital_scorecard", "range", ("outcome_composite",), (0, 100)),
    ModelTest("mart_hospital_scorecard", "values", ("outcome_tier",), fv.OUTCOME_TIERS),
    ModelTest("mart_hospital_scorecard", "coverage", ("facility_id",), parent=("dim_hospital", "facility_id")),
    *_each("mart_state_summary", "unique", "state"),
    *_each("mart_state_summary", "not_null", "state"),
)

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("test", T.StringType()),
    T.StructField("offending", T.LongType()), T.StructField("grade", T.StringType()),
    T.StructField("message", T.StringType()),
])


def _offends(test: ModelTest) -> Column | None:
    """Whether a row offends, for tests that judge single rows; NULLs offend only where they are asked for."""
    if test.kind == "not_null":
        return F.col(test.columns[0]).isNull()
    if test.kind == "values":
        return ~F.col(test.columns[0]).isin(list(test.values))
    if test.kind == "range":
        return ~F.col(test.columns[0]).between(*test.values)
    return None


def _offending(test: ModelTest, models: Mapping[str, DataFrame]) -> DataFrame:
    """The offending rows, keys or groups of a test that looks at more than one row."""
    df = models[test.model]
    if test.kind == "unique":
        known = df.where(F.col(test.columns[0]).isNotNull()) if len(test.columns) == 1 else df
        return tests.duplicate_keys(known, test.columns)
    if test.kind == "relationship":
        parent, column = test.parent
        return tests.orphan_counts(df, test.columns[0], models[parent], column)
    if test.kind == "coverage":
        return tests.not_in_both(models[test.parent[0]], df, test.columns[0])
    if test.kind == "tiling":
        return tests.tiling_faults(df, test.columns[0])
    if test.kind == "direction":
        return tests.wrong_direction(df, *test.columns)
    raise ValueError(f"no test of kind {test.kind}")


def _graded(test: ModelTest, offending: int, message: str = "") -> tuple:
    grade = "error" if test.error_above is not None and offending > test.error_above else "warn" if offending > test.warn_above else "pass"
    return test.model, test.name, offending, grade, message


def _broken(test: ModelTest, error: Exception) -> tuple:
    said = (str(error).splitlines() or [""])[0][:300]
    return test.model, test.name, None, "error" if test.error_above is not None else "warn", f"did not run: {type(error).__name__}: {said}"


def _contract(test: ModelTest, models: Mapping[str, DataFrame]) -> tuple:
    faults = tests.contract_faults(models[test.model], T.StructType(list(test.values)))
    return _graded(test, len(faults), "; ".join(faults))


def _one(test: ModelTest, models: Mapping[str, DataFrame]) -> tuple:
    try:
        if test.kind == "contract":
            return _contract(test, models)
        offends = _offends(test)
        found = _offending(test, models) if offends is None else models[test.model].where(offends)
        if test.kind == "relationship":                # rows are meant, and come counted by key
            return _graded(test, found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return _graded(test, found.count())
    except (PySparkException, KeyError, ValueError) as error:
        return _broken(test, error)


def _row_tests(some: Sequence[ModelTest], models: Mapping[str, DataFrame]) -> list[tuple]:
    """One pass over a model for all of its row tests; each on its own if the pass cannot run."""
    try:
        counted = models[some[0].model].agg(*[F.count_if(_offends(t)).alias(f"n{k}") for k, t in enumerate(some)]).first()
        return [_graded(t, n) for t, n in zip(some, counted, strict=True)]
    except (PySparkException, KeyError):
        return [_one(t, models) for t in some]


def run_model_tests(spark: SparkSession, models: Mapping[str, DataFrame], declared: Sequence[ModelTest] = MODEL_TESTS) -> DataFrame:
    """``(model, test, offending, grade, message)``, one row per test.

    ``offending`` counts rows, or keys and groups where a test judges these; it is
    NULL for a test that did not run.  Tests of models that are not given did not
    run either.  Only the counts come to the driver, one number per test.
    """
    by_model: dict[str, list[ModelTest]] = {}
    for test in declared:
        if _offends(test) is not None:
            by_model.setdefault(test.model, []).append(test)
    works: list[Callable[[], list[tuple]]] = [lambda some=some: _row_tests(some, models) for some in by_model.values()]
    works += [lambda test=test: [_one(test, models)] for test in declared if _offends(test) is None]
    found = {row[:2]: row for rows in together(spark, *works) for row in rows}
    return spark.createDataFrame([found[t.model, t.name] for t in declared], RESULT_SCHEMA)


def enforce(results: DataFrame) -> None:
    """Stop when a test ended with ``error``.  Results hold one row per test."""
    failed = sorted(f"{r.model}.{r.test}" for r in results.where(F.col("grade") == "error").collect())
    if failed:
        raise ModelTestError(f"{len(failed)} model test(s) failed: {', '.join(failed)}")
