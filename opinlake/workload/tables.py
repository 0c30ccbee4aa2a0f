"""Review relations derived from the test tables.

The test tables hold no reviews. The texts below derive some, edge cases on purpose: missing
and malformed values, blanks of several kinds, odd letter case, test products, and one
product with about a third of all historical rows. They are the input of the queries and of
their SQL counterparts alike; where the engines name a function differently the text has a
`<placeholder>`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.operators.events import encode
from opinlake.session import spread

_DIALECTS = {
    "spark": {"ship_seconds": "unix_seconds(CAST(l_shipdate AS TIMESTAMP))"},
    "duckdb": {"ship_seconds": "CAST(epoch(l_shipdate) AS BIGINT)"},
}

# Historical rows as they stand in the CSV: all text.
HISTORY = """
SELECT
 CASE WHEN k % 97 = 0 THEN 'n/a' WHEN k % 89 = 0 THEN NULL
      WHEN k % 103 = 0 THEN CAST(l_orderkey * 10 + l_linenumber AS STRING) || '.0'
      ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS Id,
 CASE WHEN k % 83 = 0 THEN NULL WHEN k % 79 = 0 THEN '  '
      WHEN l_returnflag = 'R' THEN 'P1'
      WHEN l_partkey % 50 = 0 THEN 'E2E-' || CAST(l_partkey AS STRING)
      WHEN l_partkey % 37 = 0 THEN ' p' || CAST(l_partkey AS STRING) || ' '
      ELSE 'P' || CAST(l_partkey AS STRING) END AS ProductId,
 CASE WHEN k % 73 = 0 THEN ' ' ELSE 'U' || CAST(l_suppkey AS STRING) END AS UserId,
 CAST(NULL AS STRING) AS ProfileName,
 CAST(l_linenumber AS STRING) AS HelpfulnessNumerator,
 '7' AS HelpfulnessDenominator,
 CASE WHEN k % 71 = 0 THEN 'oops' WHEN k % 67 = 0 THEN '9' WHEN k % 61 = 0 THEN '2.7'
      WHEN k % 59 = 0 THEN NULL WHEN k % 31 = 0 THEN CAST(1 + k % 5 AS STRING) || '.0'
      ELSE CAST(1 + k % 5 AS STRING) END AS Score,
 CASE WHEN k % 53 = 0 THEN 'later' WHEN k % 47 = 0 THEN NULL
      WHEN k % 101 = 0 THEN '999999999999' WHEN k % 107 = 0 THEN '-99999999999999999'
      WHEN k % 29 = 0 THEN CAST(<ship_seconds> + l_linenumber AS STRING) || '.0'
      ELSE CAST(<ship_seconds> + l_linenumber AS STRING) END AS Time,
 l_linestatus AS Summary,
 CASE WHEN k % 43 = 0 THEN '   ' WHEN k % 41 = 0 THEN NULL
      WHEN k % 8 = 0 THEN 'Great value, love it'
      WHEN k % 8 = 1 THEN 'stale and broken'
      WHEN k % 8 = 2 THEN 'it is fine'
      WHEN k % 8 = 3 THEN 'good "quoted" text, with comma' || chr(10) || 'second line'
      WHEN k % 8 = 4 THEN 'Not bad, quite tasty'
      WHEN k % 8 = 5 THEN 'line one' || chr(10) || 'line two'
      WHEN k % 8 = 6 THEN 'Très fraîche, but ébad and bad_ are no words'
      ELSE chr(9) || 'tab first' || chr(10) END AS Text
FROM (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM {lineitem}) AS l
UNION ALL
SELECT
 CAST(100000000000 + doc_id AS STRING), 'P' || CAST(doc_id % 300 AS STRING),
 'D' || CAST(doc_id % 97 AS STRING), CAST(NULL AS STRING), '0', '0',
 CAST(1 + n_chars % 5 AS STRING), CAST(1700000000 + doc_id * 60 AS STRING), lang, text
FROM {documents}
"""

# Live reviews before they are encoded as events.
LIVE = """
SELECT
 event_id, ts,
 CASE WHEN event_id % 50 = 0 THEN 'e2e-' || CAST(event_id % 7 AS STRING)
      WHEN event_id % 41 = 0 THEN CAST(NULL AS STRING)
      WHEN event_id % 43 = 0 THEN ''
      WHEN event_id % 37 = 0 THEN ' p' || CAST(event_id % 14 + 1 AS STRING) || ' '
      ELSE 'P' || CAST(event_id % 14 + 1 AS STRING) END AS product_id,
 'U' || CAST(user_id AS STRING) AS user_id,
 CAST(1 + (CAST(floor(value) AS BIGINT) + event_id) % 5 AS INT) AS score,
 CASE event_id % 12
   WHEN 0 THEN 'Great fresh green tea, I love it.'
   WHEN 1 THEN 'Stale and BROKEN on arrival'
   WHEN 2 THEN 'fine'
   WHEN 3 THEN '   '
   WHEN 4 THEN CAST(NULL AS STRING)
   WHEN 5 THEN 'greatness debatable'
   WHEN 6 THEN 'not bad, quite tasty'
   WHEN 7 THEN '  two   words  '
   WHEN 8 THEN 'The worst; disgusting!'
   WHEN 9 THEN chr(10) || chr(9)
   WHEN 10 THEN chr(160) || 'hard blank' || chr(160)
   ELSE 'line one' || chr(10) || 'line two' END AS text,
 CASE event_id % 3 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'web' ELSE 'amazon_csv' END
   AS source,
 CAST(event_id AS STRING) AS review_id,
 CASE WHEN event_id % 29 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE CAST(ts AS TIMESTAMP) END
   AS created_at
FROM {events}
"""

# Reviews as a client submits them, before any check.
SUBMISSIONS = """
SELECT
 'e' || CAST(event_id AS STRING) AS id,
 CASE WHEN event_id % 41 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 43 = 0 THEN chr(9) || ' '
      WHEN event_id % 53 = 0 THEN repeat('p', 101)
      ELSE chr(160) || 'P' || CAST(event_id % 14 + 1 AS STRING) || chr(10) END AS product_id,
 CASE WHEN event_id % 31 = 0 THEN '' WHEN event_id % 47 = 0 THEN repeat('u', 101)
      WHEN event_id % 59 = 0 THEN CAST(NULL AS STRING)
      ELSE ' U' || CAST(user_id AS STRING) END AS user_id,
 CASE WHEN event_id % 61 = 0 THEN CAST(NULL AS INT) ELSE CAST(event_id % 7 AS INT) END AS score,
 CASE event_id % 5 WHEN 0 THEN chr(10) || chr(9) WHEN 1 THEN CAST(NULL AS STRING)
   WHEN 2 THEN ' padded ' ELSE 'a plain text' END AS text,
 CASE event_id % 9 WHEN 0 THEN '  ' WHEN 1 THEN repeat('s', 51) WHEN 2 THEN CAST(NULL AS STRING)
   ELSE ' web ' END AS source,
 ts
FROM {events}
UNION ALL
SELECT 'd' || CAST(doc_id AS STRING), 'P' || CAST(doc_id % 20 AS STRING),
 'U' || CAST(doc_id AS STRING), CAST(1 + doc_id % 5 AS INT), text, lang,
 TIMESTAMP '2024-01-01 00:00:00'
FROM {documents}
"""

# Texts of every kind, for the text measures.
TEXTS = """
SELECT 'd' || CAST(doc_id AS STRING) AS id, text FROM {documents}
UNION ALL
SELECT 'e' || CAST(event_id AS STRING), text FROM ({live}) AS live
"""

# A valid catalog that misses some reviewed products.
CATALOG = """
SELECT CASE WHEN p_partkey % 50 = 0 THEN 'E2E-' ELSE 'P' END || CAST(p_partkey AS STRING)
   AS product_id,
 p_name AS name, p_type AS category, p_brand AS description,
 'https://images.example/' || CAST(p_partkey AS STRING) AS image_url,
 p_retailprice AS price, split(p_name, ' ') AS tags
FROM {part} WHERE p_partkey % 7 <> 0
"""

# Catalog rows before any check.
RAW_CATALOG = """
SELECT p_partkey,
 CASE WHEN p_partkey % 23 = 0 THEN ' ' ELSE ' P' || CAST(p_partkey AS STRING) || chr(10) END
   AS product_id,
 CASE WHEN p_partkey % 11 = 0 THEN chr(9) ELSE p_name || ' ' END AS name,
 CASE WHEN p_partkey % 17 = 0 THEN CAST(NULL AS STRING) ELSE p_type END AS category,
 p_brand AS description,
 CASE WHEN p_partkey % 19 = 0 THEN '' ELSE 'https://images.example/' || p_brand END AS image_url,
 CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice - 1 ELSE p_retailprice END AS price,
 split(' ' || p_name || '; ;' || p_type || ' ', ';') AS tags
FROM {part}
"""


def duckdb_text(template: str) -> str:
    """The derivation as a query on the registered tables."""
    names = ("lineitem", "documents", "events", "part")
    text = template.replace("{live}", LIVE)
    for name in names:
        text = text.replace("{" + name + "}", name)
    return _in_dialect(text, "duckdb").strip()


def _in_dialect(text: str, dialect: str) -> str:
    for name, code in _DIALECTS[dialect].items():
        text = text.replace(f"<{name}>", code)
    return text


def _derive(spark: SparkSession, template: str, **tables: DataFrame) -> DataFrame:
    text = _in_dialect(template.replace("{live}", LIVE), "spark")
    return spark.sql(text, **tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(
        spark,
        HISTORY,
        lineitem=table(spark, sf_dir, "lineitem"),
        documents=table(spark, sf_dir, "documents"),
    )


def live_reviews(events: DataFrame) -> DataFrame:
    return _derive(events.sparkSession, LIVE, events=events)


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _derive(
        spark,
        SUBMISSIONS,
        events=table(spark, sf_dir, "events"),
        documents=spread(table(spark, sf_dir, "documents")),
    )
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(
        spark,
        TEXTS,
        events=table(spark, sf_dir, "events"),
        documents=spread(table(spark, sf_dir, "documents").select("doc_id", "text")),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, CATALOG, part=table(spark, sf_dir, "part"))


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, RAW_CATALOG, part=table(spark, sf_dir, "part"))


def kafka_records(events: DataFrame) -> DataFrame:
    """Kafka records of the live reviews, some of them malformed, from a batch or a stream."""
    encoded = encode(live_reviews(events), "event_id", "ts")
    case, value = F.col("event_id") % 100, F.col("value")
    score = r'"score":(\d)'
    damaged = (
        F.when(case == 0, F.lit("garbage"))
        .when(case == 33, F.lit(None))
        .when(case == 7, F.lit(""))
        .when(case == 13, F.lit("  "))
        .when(case == 19, F.lit("{}"))
        .when(case == 23, F.lit("null"))
        .when(case == 51, F.regexp_replace(value, score, '"score":"$1"'))
        .when(case == 67, F.regexp_replace(value, score, '"score":$1.5'))
        .when(case == 77, F.regexp_replace(value, score + ",", ""))
        .when(case == 83, F.regexp_replace(value, r'"created_at":"[^"]*"', '"created_at":"soon"'))
        .otherwise(value)
    )
    return encoded.select(
        F.col("key").cast("binary").alias("key"),
        damaged.cast("binary").alias("value"),
        F.lit("reviews").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def record_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_records(spread(table(spark, sf_dir, "events")))


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, turned into Kafka records on the way. The path is
    a pattern because a stream takes a single file, unlike a folder, only by pattern."""
    stored = table(spark, sf_dir, "events")
    events = spark.readStream.schema(stored.schema).parquet(f"{sf_dir}/events.parque[t]")
    # As `spread` does: few large files would keep encoding and decoding on as many tasks.
    cores = spark.sparkContext.defaultParallelism
    if stored.rdd.getNumPartitions() < cores:
        events = events.repartition(cores, "event_id")
    return kafka_records(events)


# A compressed file is read by one task, so it must not be large.
COMPRESSED_CSV = {
    "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000",
}


def write_history_csv(rows: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
    """As many files as the rows have partitions, blanks and quotes kept."""
    (
        rows.select(*schemas.HISTORY_CSV.fieldNames())
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**(options or {}))
        .csv(path)
    )
