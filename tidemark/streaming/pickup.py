"""New bronze files to silver partitions, as a stream that stops when caught up.

The stream's checkpoint remembers which files were seen and so stands in for
the comparison of release lists.  A micro-batch only names the releases it
touches; each of those is rebuilt from all of its bronze rows, so a release
that arrives in several batches ends up complete and a replayed batch changes
nothing.  Releases, rejects and counts are treated and noted as a refresh does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.silver import process_releases


def pick_up(spark: SparkSession, bronze_folder: str, silver_folder: str, quarantine_folder: str, dataset: str,
            checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Only folder names of arrived files are read, so by default one batch names them all and each release is rebuilt once."""
    bronze_path = f"{bronze_folder}/{dataset}"
    schema = spark.read.option("mergeSchema", True).parquet(bronze_path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrivals = reader.parquet(bronze_path).select("release_date")

    def rebuild(batch: DataFrame, _: int) -> None:
        touched = batch.select(batch.release_date.cast("string")).distinct()
        releases = sorted(r[0] for r in touched.collect())  # one row per release
        if releases:
            process_releases(batch.sparkSession, bronze_folder, silver_folder, quarantine_folder, dataset, [(r, None) for r in releases])

    return (arrivals.writeStream.foreachBatch(rebuild)
                    .option("checkpointLocation", checkpoint)
                    .trigger(availableNow=True).start())
