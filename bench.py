"""Seconds per headline query; prints one JSON line.

``refresh`` is the whole pipeline on every row of the feeds derived from the
test tables: land, manifest, clean, check, model, test, publish, logs.  ``second_refresh`` is
the same after one release was delivered again.  The queries after it read
stored input, the way they would after a refresh.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindings.registry import ENTRIES  # noqa: E402
from bindings.tables import chain  # noqa: E402

import bindings.all_queries  # noqa: E402, F401
from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans import refresh as job  # noqa: E402
from tidemark.session import get_session, shared_folder  # noqa: E402
from tidemark.sources import lake  # noqa: E402
from tidemark.sources.feeds import FEEDS  # noqa: E402

HEADLINE = ["silver_hospitals", "silver_measures", "silver_survey", "hospital_versions", "scores_benchmarked",
            "hospital_scorecard", "state_summary", "measure_benchmarks", "rating_changes", "survey_pivot", "silver_gate",
            "dedupe_lines", "price_by_nation_latest_year", "price_quantiles", "price_percent_rank", "customer_versions",
            "content_sums", "state_medians", "national_kpis"]


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def whole_pipeline(spark, sf_dir: str) -> dict[str, float]:
    """Seconds to land all feeds, for a first refresh, and for one after a single release was delivered again."""
    folders, c = job.Lake(f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"), chain(spark, sf_dir)
    spent, moment = {}, job.now().isoformat()
    days = {n: sorted(r[0] for r in c.bronze(n).select("release_date").distinct().collect()) for n in FEEDS}   # one row per release

    def land(n, rows, releases):
        lake.write_partitions(rows, f"{folders.bronze}/{n}", ["release_date"])
        job.note_landed(spark, folders, n, releases, sorted(set(rows.columns) - {"release_date", "_ingested_at"}), "bench", moment)

    def refresh():
        return job.refresh(spark, folders.root, as_of="2001-06-30", blocking=False)     # the feeds carry faults on purpose

    spent["land"] = timed(lambda: [land(n, c.bronze(n), days[n]) for n in FEEDS])
    spent["refresh"] = timed(refresh)
    tasks = spark.read.parquet(f"{folders.ops}/task_runs")
    spent |= {f"of which {r.task}": r.duration_s for r in tasks.collect()}               # one row per step
    newest = days["complications_deaths"][-1]
    land("complications_deaths", c.bronze("complications_deaths").where(F.col("release_date") == newest)
         .withColumn("footnote", F.lit("corrected")), [newest])
    spent["second refresh"] = timed(refresh)
    return spent


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.checkpoint.dir": os.environ.get("BENCH_FOLDER", "/tmp/tidemark-bench")})
    spark.sparkContext.setLogLevel("ERROR")
    c = chain(spark, sf_dir)
    rows = sum(c.bronze(name).count() for name in FEEDS)
    stages = whole_pipeline(spark, sf_dir)
    seconds = {"refresh": round(stages["land"] + stages["refresh"], 3), "second_refresh": stages["second refresh"]}
    for name in ("hospitals", "measure_scores", "hcahps", "facts", "history", "dim", "measures", "experience", "scorecard"):
        getattr(c, name)
    for name in HEADLINE:
        seconds[name] = timed(lambda name=name: run(ENTRIES[name].run(spark, sf_dir)))
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "refresh_stages": stages, "bronze_rows": rows,
                      "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
