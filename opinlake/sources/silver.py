"""The silver relation: its two lanes, the external tables over them, and simple looks at it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.functions.times import to_plain_values
from opinlake.layout import LakeLayout
from opinlake.plans.compaction import read_stream_lane
from opinlake.plans.loads import published_loads, read_loads
from opinlake.plans.micro_batches import last_visible

LANES = ("batch", "stream")


class MissingLane(FileNotFoundError):
    """A lane of silver that was asked for is not there."""


def _lane(spark: SparkSession, layout: LakeLayout, lane: str) -> DataFrame | None:
    try:
        if lane == "stream":
            return read_stream_lane(spark, layout)
        return read_loads(spark, layout)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_silver(
    spark: SparkSession,
    layout: LakeLayout,
    lanes: Sequence[str] = LANES,
    optional: Sequence[str] = (),
) -> DataFrame:
    """The lanes as one relation.

    A lane that is not there is an error, since an empty relation would look like an empty
    lake; lanes named in `optional` are left out instead, but one at least must be there.

    Each lane is read from its own folder, which keeps the commit log of the stream's file
    sink in force: files of unfinished micro-batches stay invisible. So do loads that have not come
    to their end. A compacted stream lane is read from its sorted files and what has come since.
    """
    paths = {"batch": layout.silver_batch, "stream": layout.silver_stream}
    found = {lane: _lane(spark, layout, lane) for lane in lanes}
    missing = [lane for lane, rows in found.items() if rows is None and lane not in optional]
    written = [rows for rows in found.values() if rows is not None]
    if missing or not written:
        absent = missing or list(lanes)
        raise MissingLane(f"no silver at {', '.join(paths[lane] for lane in absent)}")
    return union_lanes(*written)


def union_lanes(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append lanes by column name, in the fixed column order."""
    rows = first
    for lane in others:
        rows = rows.unionByName(lane)
    return rows.select(*schemas.SILVER.fieldNames())


def create_external_tables(
    spark: SparkSession, layout: LakeLayout, database: str, view: str = "reviews_enriched"
) -> str:
    """An external table and a view of its visible rows for each lane and for the fan-out, if there
    is one, and a view over all; returns the name of the latter.

    Dropping and creating again changes only the catalog, never the files. A lane not yet
    written is an empty table. The views hold the loads that are visible now: after further
    loads create them again (and `REFRESH TABLE` the stream's).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{layout.base}/{database}.db'")
    columns = schemas.SILVER.toDDL()
    names = ", ".join(f"`{name}`" for name in schemas.SILVER.fieldNames())
    loads = published_loads(spark, layout)
    kept = f"load IN ({', '.join(repr(load) for load in loads)})" if loads else "false"
    lanes = {
        "batch": (layout.silver_batch, f"{columns}, load STRING", "PARTITIONED BY (load)", kept),
        "stream": (layout.silver_stream, columns, "", "true"),
    }
    last = last_visible(spark, layout)
    if last is not None:
        by_batch = (f"{columns}, batch BIGINT", "PARTITIONED BY (batch)", f"batch <= {last}")
        lanes["fanout"] = (layout.fanout_silver, *by_batch)
    parts = []
    for lane, (path, fields, partitioned, shown) in lanes.items():
        files, part = f"{database}.{view}_{lane}_files", f"{database}.{view}_{lane}"
        spark.sql(f"DROP TABLE IF EXISTS {files}")
        spark.sql(f"CREATE TABLE {files} ({fields}) USING PARQUET {partitioned} LOCATION '{path}'")
        if lane == "fanout":
            spark.sql(f"ALTER TABLE {files} RECOVER PARTITIONS")
        elif partitioned and loads:
            # The catalog keeps the list of partitions: visible loads only.
            listed = " ".join(f"PARTITION (load={load!r})" for load in loads)
            spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {listed}")
        spark.sql(f"CREATE OR REPLACE VIEW {part} AS SELECT {names} FROM {files} WHERE {shown}")
        parts.append(part)
    union = " UNION ALL ".join(f"SELECT {names} FROM {part}" for part in parts)
    name = f"{database}.{view}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {union}")
    return name


def fetch_one(report: DataFrame) -> dict:
    """The first row of a report as a dict, or an empty one."""
    row = to_plain_values(report.limit(1)).first()
    return row.asDict() if row else {}


def fetch_report(report: DataFrame, bound: int) -> list[dict]:
    """The rows of a report as dicts of plain values. The caller names the bound that its
    report has; more rows are an error, not cut off: relations without a bound stay frames or
    go to a table, not to the driver."""
    rows = to_plain_values(report).limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"the report has more than {bound} rows; write it to a table")
    return [row.asDict() for row in rows]


def table_peek(spark: SparkSession, table: str) -> DataFrame:
    """Column names and types of a table together with its row count."""
    rows = spark.table(table)
    columns = F.array(
        *(
            F.struct(
                F.lit(field.name).alias("col_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
            )
            for field in rows.schema.fields
        )
    )
    return (
        rows.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.inline(columns).alias("col_name", "data_type"), "row_count")
    )


def first_rows(
    spark: SparkSession, table: str, n: int = 10, order: Sequence[str] = ()
) -> DataFrame:
    """Some rows of a table, or the first ones in the given order."""
    rows = spark.table(table)
    return (rows.orderBy(*(F.asc_nulls_last(c) for c in order)) if order else rows).limit(n)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def silver_preview(silver: DataFrame, n: int = 20) -> DataFrame:
    """The latest stream rows by offset. Rows without one come last; the remaining columns
    settle ties.

    Two passes, as for the newest reviews: a top-k over the offsets alone gives the offset
    that `n` rows reach, and with it the second pass skips the texts of older row groups and of
    all historical rows, which have none. With fewer than `n` offsets every row is looked at.
    """
    shown = (
        "product_id", "user_id", "score", "sentiment", "source", "text_length", "word_count",
        "has_negative_keywords", "has_positive_keywords", "text", "review_id", "created_at",
        "offset",
    )
    ties = ("review_id", "product_id", "user_id", "score", "text")
    known = silver.where(F.col("offset").isNotNull())
    latest = known.select("offset").orderBy(F.desc("offset")).limit(n)
    # At most `n` numbers: whether there are enough decides which rows can be among the last.
    reached = latest.agg(F.count(F.lit(1)).alias("rows"), F.min("offset").alias("since")).first()
    if reached["rows"] >= n:
        silver = silver.where(F.col("offset") >= reached["since"])
    return (
        silver.select(*shown)
        .orderBy(F.desc_nulls_last("offset"), *(F.asc_nulls_first(c) for c in ties))
        .limit(n)
    )
