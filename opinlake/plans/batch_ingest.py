"""The historical load: CSV rows into bronze and silver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.layout import LakeLayout, history_csv_path
from opinlake.operators.cleaning import clean_history, created_at, history_to_silver
from opinlake.plans.loads import AUDIT_SCHEMA, folder_of, load_name, publish_load, published_loads
from opinlake.session import FREE_SHUFFLES, lake_session, with_settings
from opinlake.sources.history_csv import read_history_csv


# Texts are measured behind the shuffle, so a small load must not end up in one task. Bronze is read in
# small parts, as its files are compressed.
_SPREAD = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
}

# Ranges of time hold equally many rows, so a stretch of long texts needs many of them. Adaptive execution
# puts those of short texts together again; it knows their sizes up to EXACT_SIZES partitions, so beyond
# that ranges get larger, up to LARGEST_RANGE rows.
RANGE_ROWS, LARGEST_RANGE, EXACT_SIZES = 1 << 14, 1 << 16, 2000

# Compressed text is read by one task a file.
_BRONZE = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}

# Whatever the session's codec: texts hardly get smaller with the default one.
_SILVER = {"compression": "zstd"}


@dataclass(frozen=True)
class IngestAudit:
    raw_rows: int
    cleaned_rows: int
    written_rows: int

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.raw_rows, self.cleaned_rows, self.written_rows)],
            AUDIT_SCHEMA,
        )


def ingest_history(raw: DataFrame, layout: LakeLayout, load_id: str | None = None) -> IngestAudit:
    """Add a load: cleaned rows to bronze and enriched rows to silver, visible together.

    A load that failed is repeated with its `load_id` and leaves no row twice; one that is visible
    already is not done again, its audit is returned. Without an id every call is a new load.

    The input is parsed once. Bronze is the stored copy of its cleaned rows; silver is made from
    there. Rows are dealt out by ranges of time before they are enriched, as the ranges are found by
    a look at all rows: so a file holds a stretch of time, reports on the newest reviews skip the
    other files, and texts are measured once. How many files that makes is left to adaptive execution,
    which gives every core a file of a small load, but none below 8 MB.

    The three counts are observed on the way, so auditing reads nothing twice. A lost executor
    costs its tasks.
    """
    spark, load = raw.sparkSession, load_name(load_id)
    audits = f"{layout.loads}/audits"
    if load in published_loads(spark, layout):
        done = spark.read.schema(AUDIT_SCHEMA).json(folder_of(audits, load)).first()
        return IngestAudit(*done)
    counts = {name: Observation(name) for name in ("raw", "cleaned", "written")}

    def observed(rows: DataFrame, name: str) -> DataFrame:
        return rows.observe(counts[name], F.count(F.lit(1)).alias("rows"))

    bronze, silver = folder_of(layout.bronze_batch, load), folder_of(layout.silver_batch, load)
    cleaned = observed(clean_history(observed(raw, "raw")), "cleaned")
    cleaned.write.mode("overwrite").options(**_BRONZE).json(bronze)
    stored = spark.read.schema(schemas.HISTORY_CSV).json(bronze)
    at = stored.withColumn("_at", created_at())
    by_time = at.repartitionByRange("_at").sortWithinPartitions("_at").drop("_at")
    ranges = _ranges(spark, counts["cleaned"].get["rows"])
    with with_settings(spark, _SPREAD | ranges | FREE_SHUFFLES):
        written = observed(history_to_silver(by_time), "written")
        written.write.mode("overwrite").options(**_SILVER).parquet(silver)
    audit = IngestAudit(*(counts[name].get["rows"] for name in ("raw", "cleaned", "written")))
    audit.to_frame(spark).coalesce(1).write.mode("overwrite").json(folder_of(audits, load))
    publish_load(spark, layout, load)
    return audit


def _ranges(spark: SparkSession, rows: int) -> dict[str, str]:
    """Enough shuffle partitions for so many rows."""
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(min(rows // RANGE_ROWS, EXACT_SIZES), rows // LARGEST_RANGE)
    return {"spark.sql.shuffle.partitions": str(max(given, ranges))}


def main(load_id: str | None = None) -> None:
    spark, layout = lake_session("opinlake-history")
    path = history_csv_path()
    audit = ingest_history(read_history_csv(spark, path), layout, load_id)
    print(f"{path}: {audit}")
    spark.stop()


if __name__ == "__main__":
    main()
