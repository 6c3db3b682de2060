"""The four feeds: key columns, typed tables they fill, and lookup tables."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fv


@dataclass(frozen=True)
class Feed:
    """One published feed and the silver table it fills."""

    name: str
    title: str
    table: str
    key: tuple[str, ...]
    partitions: tuple[str, ...] = ("release_date",)


FEEDS = {
    f.name: f
    for f in (
        Feed("hospital_info", "General information", "hospitals", ("facility_id", "release_date")),
        Feed("complications_deaths", "Complications and deaths", "measure_scores",
             ("facility_id", "measure_id", "release_date"), ("source_dataset", "release_date")),
        Feed("unplanned_visits", "Unplanned visits", "measure_scores",
             ("facility_id", "measure_id", "release_date"), ("source_dataset", "release_date")),
        Feed("hcahps", "Patient survey", "hcahps", ("facility_id", "measure_id", "release_date")),
    )
}

# Columns each silver table must offer before gold is built.
REQUIRED_COLUMNS = {
    "hospitals": ["facility_id", "facility_name", "state", "hospital_type", "ownership", "overall_rating",
                  "has_emergency_services", "release_date"],
    "measure_scores": ["facility_id", "measure_id", "compared_to_national", "score", "lower_estimate",
                       "higher_estimate", "period_start", "period_end", "source_dataset", "release_date"],
    "hcahps": ["facility_id", "measure_id", "star_rating", "answer_percent", "completed_surveys", "release_date"],
}

#: Types of these columns.
SILVER_TYPES = {
    **dict.fromkeys(["facility_id", "facility_name", "state", "hospital_type", "ownership", "release_date", "measure_id",
                     "compared_to_national", "source_dataset"], "string"),
    **dict.fromkeys(["overall_rating", "star_rating", "answer_percent", "completed_surveys"], "int"),
    **dict.fromkeys(["score", "lower_estimate", "higher_estimate"], "double"),
    **dict.fromkeys(["period_start", "period_end"], "date"), "has_emergency_services": "boolean",
}

DIM_HOSPITAL_CONTRACT = T.StructType([
    T.StructField("facility_id", T.StringType(), False),
    T.StructField("facility_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("census_region", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("county", T.StringType()),
    T.StructField("hospital_type", T.StringType()),
    T.StructField("ownership", T.StringType()),
    T.StructField("ownership_group", T.StringType()),
    T.StructField("has_emergency_services", T.BooleanType()),
    T.StructField("is_birthing_friendly", T.BooleanType()),
    T.StructField("overall_rating", T.IntegerType()),
    T.StructField("release_date", T.DateType()),
])

REGION_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in fv.STATE_REGIONS_HEADER])
CATALOG_SCHEMA = T.StructType([
    T.StructField(n, T.BooleanType() if n == "lower_is_better" else T.StringType())
    for n in fv.MEASURE_CATALOG_HEADER
])


def lookup_rows(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.splitlines()]


def _lookup(spark: SparkSession, text: str, schema: T.StructType) -> DataFrame:
    """A local relation: Spark knows its size, so joins to it need no hint."""
    columns = zip(*lookup_rows(text), strict=True)
    table = pa.table({name: list(column) for name, column in zip(schema.names, columns, strict=True)})
    return spark.createDataFrame(table).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def state_regions(spark: SparkSession) -> DataFrame:
    return _lookup(spark, fv.STATE_REGIONS_TEXT, REGION_SCHEMA)


def measure_catalog(spark: SparkSession) -> DataFrame:
    return _lookup(spark, fv.MEASURE_CATALOG_TEXT, CATALOG_SCHEMA)


def read_lookup_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A lookup table kept as CSV with a header, typed by ``schema``."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
