"""Named queries. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.functions import review as rv
from opinlake.functions import text as tx
from opinlake.functions.times import to_plain_values
from opinlake.layout import LakeLayout
from opinlake.operators import catalog as ct
from opinlake.operators import cleaning, dedup, events, quality
from opinlake.operators import reports as rp
from opinlake.plans import batch_ingest, compaction, loads, partials, snapshot
from opinlake.plans import dashboard as db
from opinlake.session import apply_lake_settings, materialize, scratch_path, spread
from opinlake.sources import catalog as catalog_source
from opinlake.sources import events as event_source
from opinlake.sources import history_csv, silver
from opinlake.streaming import fanout, jobs, running
from opinlake.workload import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_lake_settings(spark)
        return function(spark, sf_dir.rstrip("/"))

    QUERIES[function.__name__] = run
    return run


# --- written once per application and data folder -----------------------------------

_written: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]):
    """The result of `write`, which gets a fresh path in the shared folder on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = write(scratch_path(spark, name))
    return _written[key]


def history_folder(spark: SparkSession, sf_dir: str) -> str:
    """The raw historical rows as a landing table."""

    def write(path: str) -> str:
        spread(tb.history_rows(spark, sf_dir)).write.option("compression", "zstd").parquet(path)
        return path

    return _once(spark, sf_dir, "history", write)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.HISTORY_CSV).parquet(history_folder(spark, sf_dir))


def history_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The same rows as compressed CSV files."""

    def write(path: str) -> str:
        tb.write_history_csv(history(spark, sf_dir), path, tb.COMPRESSED_CSV)
        return path

    return _once(spark, sf_dir, "history_csv", write)


def sample_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The rows that pass cleaning as CSV files: a trusted sample."""

    def write(path: str) -> str:
        # A strict read insists on plain integers.
        plain = {
            name: cleaning.whole_number(F.col(name), kind).cast("string")
            for name, kind in (("Score", "int"), ("Time", "bigint"))
        }
        rows = cleaning.clean_history(history(spark, sf_dir)).withColumns(plain)
        tb.write_history_csv(rows, path)
        return path

    return _once(spark, sf_dir, "sample_csv", write)


def lake(spark: SparkSession, sf_dir: str) -> LakeLayout:
    """Both silver lanes: reports read silver, they do not enrich it again."""

    def write(path: str) -> LakeLayout:
        layout = LakeLayout(path)
        batch_ingest.ingest_history(history(spark, sf_dir), layout)
        jobs.finish(
            jobs.start_silver(tb.record_stream(spark, sf_dir), layout, jobs.AVAILABLE_NOW)
        )
        return layout

    return _once(spark, sf_dir, "lake", write)


def lake_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.read_silver(spark, lake(spark, sf_dir))


# --- sources ------------------------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    return history_csv.read_history_csv(spark, history_csv_folder(spark, sf_dir))


# What the single writer of a large CSV file reads of the landing table, at most about.
LARGE_FILE_BYTES = 128 << 20


@query
def csv_scan_split(spark, sf_dir):
    """The same rows exported as one file, or a few large ones, each of which many tasks read."""

    def write(path: str) -> str:
        # A file has one writer, which must not grow with the table.
        stored = spark.read.format("binaryFile").load(f"{history_folder(spark, sf_dir)}/*.parquet")
        total = stored.agg(F.sum("length")).first()[0] or 0
        files = max(1, -(-total // LARGE_FILE_BYTES))
        tb.write_history_csv(history(spark, sf_dir).coalesce(files), path)
        return path

    folder = _once(spark, sf_dir, "history_one_csv", write)
    return history_csv.read_history_csv(spark, folder, split=True)


@query
def sample_scan(spark, sf_dir):
    return history_csv.read_sample_csv(spark, sample_csv_folder(spark, sf_dir))


@query
def silver_scan(spark, sf_dir):
    return lake_silver(spark, sf_dir)


@query
def external_table(spark, sf_dir):
    view = silver.create_external_tables(spark, lake(spark, sf_dir), "opinlake_external")
    return spark.table(view)


@query
def table_peek(spark, sf_dir):
    view = silver.create_external_tables(spark, lake(spark, sf_dir), "opinlake_peek")
    return silver.table_peek(spark, view)


@query
def catalog_list(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    tb.catalog(spark, sf_dir).write.parquet(path)
    products = catalog_source.list_products(catalog_source.read_catalog(spark, path))
    return ct.tag_text(products)


@query
def topic_peek(spark, sf_dir):
    return event_source.first_messages(tb.record_batch(spark, sf_dir))


@query
def table_first_rows(spark, sf_dir):
    view = silver.create_external_tables(spark, lake(spark, sf_dir), "opinlake_first")
    return silver.first_rows(spark, view, 10, ["review_id", "source", "created_at", "offset"])


@query
def bronze_peek(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    jobs.finish(jobs.start_bronze(tb.record_stream(spark, sf_dir), layout, jobs.AVAILABLE_NOW))
    return event_source.bronze_peek(spark, layout.bronze_stream, 5)


@query
def plain_values(spark, sf_dir):
    """Instants as reports hand them on."""
    rows = lake_silver(spark, sf_dir)
    return to_plain_values(rows.select("review_id", "source", "created_at", "kafka_timestamp"))


@query
def history_rejects(spark, sf_dir):
    rejected = cleaning.rejected_history(history(spark, sf_dir))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


@query
def silver_preview(spark, sf_dir):
    return silver.silver_preview(lake_silver(spark, sf_dir))


@query
def silver_union(spark, sf_dir):
    """Both lanes without files in between."""
    batch = cleaning.history_to_silver(cleaning.clean_history(history(spark, sf_dir)))
    stream = events.events_to_silver(tb.record_batch(spark, sf_dir))
    return silver.union_lanes(batch, stream)


# --- cleaning and ingest ------------------------------------------------------------


@query
def clean_required(spark, sf_dir):
    return cleaning.keep_required(history(spark, sf_dir))


@query
def clean_nonblank(spark, sf_dir):
    return cleaning.keep_nonblank(history(spark, sf_dir))


@query
def clean_ranges(spark, sf_dir):
    return cleaning.keep_in_range(history(spark, sf_dir))


@query
def clean_reviews(spark, sf_dir):
    return cleaning.clean_history(history(spark, sf_dir))


@query
def normalize_reviews(spark, sf_dir):
    return cleaning.history_to_silver(cleaning.clean_history(history(spark, sf_dir)))


@query
def batch_ingest_(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    raw = history_csv.read_history_csv(spark, history_csv_folder(spark, sf_dir))
    batch_ingest.ingest_history(raw, layout)
    return silver.read_silver(spark, layout, ["batch"])


QUERIES["batch_ingest"] = QUERIES.pop("batch_ingest_")


@query
def ingest_audit(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    raw = history_csv.read_history_csv(spark, history_csv_folder(spark, sf_dir))
    return batch_ingest.ingest_history(raw, layout).to_frame(spark)


@query
def bronze_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bronze_json")
    cleaning.clean_history(history(spark, sf_dir)).write.mode("append").json(path)
    return spark.read.schema(schemas.HISTORY_CSV).json(path)


@query
def batch_dedup(spark, sf_dir):
    """Both lanes loaded twice hold every review twice, and some ids in both lanes; one row of
    each is left, and all rows without an id."""
    rows = lake_silver(spark, sf_dir)
    return dedup.drop_repeats_in_rounds(rows.unionAll(rows))


# --- events -------------------------------------------------------------------------


@query
def kafka_envelope(spark, sf_dir):
    return events.open_envelope(tb.record_batch(spark, sf_dir))


@query
def json_parse(spark, sf_dir):
    return events.decode(events.open_envelope(tb.record_batch(spark, sf_dir)))


@query
def json_quarantine(spark, sf_dir):
    return events.undecodable(events.open_envelope(tb.record_batch(spark, sf_dir)))


@query
def json_accepted(spark, sf_dir):
    """What `json_quarantine` leaves."""
    bronze = events.open_envelope(tb.record_batch(spark, sf_dir))
    return events.decode(bronze, on_bad="quarantine")


@query
def kafka_encode(spark, sf_dir):
    return events.encode(tb.live_reviews(tb.table(spark, sf_dir, "events")))


@query
def json_roundtrip(spark, sf_dir):
    """Encoded and decoded again, reviews are what they were."""
    encoded = events.encode(tb.live_reviews(tb.table(spark, sf_dir, "events")))
    origin = ("topic string", "partition int", "offset bigint", "kafka_timestamp timestamp")
    bronze = encoded.select(
        F.col("key").alias("kafka_key"),
        F.col("value").alias("json_value"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in (o.split() for o in origin)),
    )
    names = schemas.REVIEW_EVENT.fieldNames()
    return events.decode(bronze).select(*names)


@query
def event_defaults(spark, sf_dir):
    rows = tb.submissions(spark, sf_dir)
    stamped = events.with_defaults(rows, events.stable_id(F.col("id")), F.col("ts"))
    return stamped.select("id", "user_id", "source", "review_id", "created_at")


@query
def enrich_reviews(spark, sf_dir):
    return events.events_to_silver(tb.record_batch(spark, sf_dir))


# --- text and rules -----------------------------------------------------------------


def _texts_with(spark, sf_dir, **measures) -> DataFrame:
    return tb.texts(spark, sf_dir).select(
        "id", *(measure.alias(name) for name, measure in measures.items())
    )


@query
def text_length(spark, sf_dir):
    return _texts_with(spark, sf_dir, text_length=tx.text_length(F.col("text")))


@query
def word_count(spark, sf_dir):
    return _texts_with(spark, sf_dir, word_count=tx.word_count(F.col("text")))


@query
def word_count_strict(spark, sf_dir):
    return _texts_with(spark, sf_dir, word_count=tx.word_count_strict(F.col("text")))


@query
def keyword_flags(spark, sf_dir):
    return _texts_with(
        spark,
        sf_dir,
        has_negative_keywords=tx.mentions_any(F.col("text"), tx.NEGATIVE_WORDS),
        has_positive_keywords=tx.mentions_any(F.col("text"), tx.POSITIVE_WORDS),
    )


@query
def sentiment_rule(spark, sf_dir):
    reviews = events.decode(events.open_envelope(tb.record_batch(spark, sf_dir)))
    return reviews.select("offset", "score", rv.sentiment_of(F.col("score")).alias("sentiment"))


@query
def row_filter(spark, sf_dir):
    return rp.counted(lake_silver(spark, sf_dir)).select("review_id", "product_id", "source")


@query
def text_filter(spark, sf_dir):
    rows = lake_silver(spark, sf_dir).where(tx.has_nonblank_text(F.col("text")))
    return rows.select("review_id", "product_id", "source")


# --- quality ------------------------------------------------------------------------


@query
def validate_reviews(spark, sf_dir):
    return quality.accepted(quality.check_reviews(tb.submissions(spark, sf_dir)))


@query
def quarantine_reasons(spark, sf_dir):
    return quality.rejection_counts(quality.check_reviews(tb.submissions(spark, sf_dir)))


@query
def catalog_validate(spark, sf_dir):
    return ct.tag_text(quality.check_products(tb.raw_catalog(spark, sf_dir)))


@query
def known_products(spark, sf_dir):
    reviews = lake_silver(spark, sf_dir).select("review_id", "product_id", "source")
    return quality.known_products(reviews, tb.catalog(spark, sf_dir))


@query
def unknown_products(spark, sf_dir):
    reviews = lake_silver(spark, sf_dir).select("review_id", "product_id", "source")
    return quality.unknown_products(reviews, tb.catalog(spark, sf_dir))


# --- catalog ------------------------------------------------------------------------


@query
def catalog_lookup(spark, sf_dir):
    return ct.tag_text(ct.find_product(tb.catalog(spark, sf_dir), " p17 "))


@query
def catalog_search(spark, sf_dir):
    """One search within a category, one over all."""
    products = tb.catalog(spark, sf_dir)
    narrow = ct.search(products, " RED ", "ECONOMY").withColumn("search", F.lit("narrow"))
    wide = ct.search(products, "Brand#2").withColumn("search", F.lit("wide"))
    return ct.tag_text(narrow.unionAll(wide))


@query
def catalog_categories(spark, sf_dir):
    return ct.categories(tb.catalog(spark, sf_dir))


@query
def enrich_catalog(spark, sf_dir):
    reviews = lake_silver(spark, sf_dir).select("review_id", "product_id", "source", "score")
    return ct.enrich_with_catalog(reviews, tb.catalog(spark, sf_dir))


@query
def product_label(spark, sf_dir):
    stats = rp.product_stats(lake_silver(spark, sf_dir))
    return ct.with_label(ct.enrich_with_catalog(stats, tb.catalog(spark, sf_dir)))


# --- reports ------------------------------------------------------------------------


def _report(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark, sf_dir):
        return report(lake_silver(spark, sf_dir))

    run.__name__ = name
    query(run)


def _named_report(name: str, report: Callable[..., DataFrame], **parameters) -> None:
    def run(spark, sf_dir):
        return report(lake_silver(spark, sf_dir), catalog=tb.catalog(spark, sf_dir), **parameters)

    run.__name__ = name
    query(run)


# The derived products have many reviews each: this many make the HAVING clause bite.
MIN_REVIEWS = 30

_report("summary", rp.summary)
_report("summary_defaults", lambda rows: rp.with_summary_defaults(rp.summary(rows)))
_report("sentiment_counts", rp.sentiment_counts)
_report("score_distribution", rp.score_distribution)
_report("score_distribution_dense", rp.score_distribution_dense)
_report("sources", rp.sources)
_report("negative_keywords", lambda rows: rp.keyword_count(rows, "negative"))
_report("positive_keywords", lambda rows: rp.keyword_count(rows, "positive"))
_named_report("product_scores", rp.product_scores)
_named_report("top_products", rp.top_products, min_reviews=MIN_REVIEWS)
_named_report("worst_products", rp.worst_products, min_reviews=MIN_REVIEWS)
_named_report("negative_products", rp.negative_products, min_reviews=MIN_REVIEWS)
_named_report("recent_reviews", rp.recent_reviews)
_named_report("opinions", rp.opinions)
_named_report("opinions_positive", rp.opinions, sentiment="positive")
_named_report("opinions_neutral", rp.opinions, sentiment="neutral")
_named_report("opinions_negative", rp.opinions, sentiment="negative")
_named_report("dashboard_recent", rp.dashboard_opinions)
_report("raw_total", rp.total)
_report("raw_sentiment", lambda rows: rp.count_by(rows, "sentiment").orderBy("sentiment"))
_report("raw_scores", lambda rows: rp.count_by(rows, "score").orderBy("score"))
_report("raw_sources", rp.raw_sources)
_report("raw_top", lambda rows: rp.best_rated(rp.product_stats(rows)))
_report("raw_worst", lambda rows: rp.worst_rated(rp.product_stats(rows)))
_report("raw_negative", lambda rows: rp.most_negative(rp.product_stats(rows, True)))
_report("raw_product_scores", rp.product_stats)
_report("dashboard_cube", db.report_cube)


@query
def scaled_counts(spark, sf_dir):
    """The bars of the three charts, each over its report: all five scores, named sources."""
    rows = lake_silver(spark, sf_dir)
    charts = {
        "sentiment": rp.sentiment_counts(rows),
        "score": rp.score_distribution_dense(rows),
        "source": rp.sources(rows),
    }
    bars = None
    for kind, report in charts.items():
        counts = report.select(F.col(kind).cast("string").alias("label"), "review_count")
        bar = rp.scaled(counts).withColumn("kind", F.lit(kind))
        bars = bar if bars is None else bars.unionByName(bar)
    return bars


# --- bundles ------------------------------------------------------------------------

_LABELS = {
    "summary": None,
    "sentiment": "sentiment",
    "score_distribution": "score",
    "sources": "source",
    "negative_keywords": "keyword_type",
    "positive_keywords": "keyword_type",
}

_BUNDLE_COLUMNS = {
    "review_id": "string",
    "product_name": "string",
    "text": "string",
    "created_at": "timestamp",
    "first_review_at": "timestamp",
    "last_review_at": "timestamp",
    "review_count": "bigint",
    "negative_review_count": "bigint",
    "average_score": "double",
}


def one_relation(bundle: dict[str, DataFrame]) -> DataFrame:
    """A bundle as one relation: report, label and whatever measures a report has."""
    rows = None
    for name, relation in bundle.items():
        for count in ("total_reviews", "matching_reviews"):
            if count in relation.columns:
                relation = relation.withColumnRenamed(count, "review_count")
        label = _LABELS.get(name, "product_id")
        part = relation.select(
            F.lit(name).alias("report"),
            (F.col(label).cast("string") if label else F.lit(None).cast("string")).alias("label"),
            *(
                (F.col(c) if c in relation.columns else F.lit(None)).cast(kind).alias(c)
                for c, kind in _BUNDLE_COLUMNS.items()
            ),
        )
        rows = part if rows is None else rows.unionAll(part)
    return rows


@query
def dashboard(spark, sf_dir):
    rows, products = lake_silver(spark, sf_dir), tb.catalog(spark, sf_dir)
    cube = materialize(db.report_cube(rows), "cube")
    newest = materialize(db.newest_opinions(rows, products), "newest")
    return one_relation(db.dashboard(cube, newest, products))


@query
def dashboard_by_report(spark, sf_dir):
    rows = lake_silver(spark, sf_dir)
    return one_relation(db.dashboard_by_report(rows, tb.catalog(spark, sf_dir)))


def _load_part(spark, sf_dir, layout: LakeLayout, part: int) -> None:
    """One of three loads that hold the historical rows."""
    rows = history(spark, sf_dir)
    number = F.pmod(F.xxhash64("Id", "Time", "Text"), F.lit(3))
    batch_ingest.ingest_history(rows.where(number == part), layout, f"part-{part}")


def _three_loads(spark, sf_dir) -> LakeLayout:
    """The batch lane only, as three loads: audits know no stream."""

    def write(path: str) -> LakeLayout:
        layout = LakeLayout(path)
        for part in range(3):
            _load_part(spark, sf_dir, layout, part)
        return layout

    return _once(spark, sf_dir, "three_loads", write)


def _in_loads(spark, sf_dir) -> LakeLayout:
    """The same silver as three loads, and a stream lane with a run and files after it. Partials are
    there for two loads and the run."""

    def write(path: str) -> LakeLayout:
        layout, replay = LakeLayout(path), f"{path}/replay"
        records = tb.record_batch(spark, sf_dir)

        def receive(half: int) -> None:
            records.where(F.col("offset") % 2 == half).write.mode("append").parquet(replay)
            stream = event_source.replay_stream(spark, replay)
            jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW))

        _load_part(spark, sf_dir, layout, 0)
        _load_part(spark, sf_dir, layout, 1)
        receive(0)
        compaction.compact_stream_lane(spark, layout)
        partials.refresh_partials(spark, layout)
        _load_part(spark, sf_dir, layout, 2)
        receive(1)
        return layout

    return _once(spark, sf_dir, "lake_in_loads", write)


@query
def dashboard_incremental(spark, sf_dir):
    """The dashboard from partial aggregates and a scan of what has none."""
    products = tb.catalog(spark, sf_dir)
    return one_relation(partials.incremental_dashboard(spark, _in_loads(spark, sf_dir), products))


@query
def load_audits(spark, sf_dir):
    """What was counted in the three loads."""
    audits = loads.load_audits(spark, _three_loads(spark, sf_dir)).drop("load")
    return audits.agg(*(F.sum(name).cast("bigint").alias(name) for name in audits.columns))


@query
def analytics_bundle(spark, sf_dir):
    rows = lake_silver(spark, sf_dir)
    return one_relation(db.analytics_bundle(rows, tb.catalog(spark, sf_dir)))


@query
def sample_dashboard(spark, sf_dir):
    sample = materialize(
        history_csv.read_sample_csv(spark, sample_csv_folder(spark, sf_dir)), "sample"
    )
    products = tb.catalog(spark, sf_dir)
    cube = materialize(db.report_cube(sample, trusted=True), "cube")
    newest = materialize(db.sample_newest(sample, products), "newest")
    return one_relation(db.sample_dashboard(cube, newest, products))


def _published(spark, sf_dir) -> tuple[LakeLayout, str]:
    gold = LakeLayout(scratch_path(spark, "gold_lake"))
    rows = lake_silver(spark, sf_dir)
    envelope = snapshot.publish_snapshot(spark, gold, rows, tb.catalog(spark, sf_dir))
    return gold, envelope["snapshot_id"]


@query
def gold_snapshot(spark, sf_dir):
    """Published, found again through the manifest, and read back."""
    gold, _ = _published(spark, sf_dir)
    envelope = silver.fetch_one(snapshot.latest_snapshot(spark, gold))
    bundle = snapshot.read_snapshot(spark, gold, envelope["snapshot_id"])
    return (
        one_relation(bundle)
        .withColumn("status", F.lit(envelope["status"]))
        .withColumn("stale", F.lit(envelope["stale"]))
    )


@query
def gold_completeness(spark, sf_dir):
    return snapshot.completeness(spark, *_published(spark, sf_dir))


# --- streaming ----------------------------------------------------------------------


@query
def stream_source_replay(spark, sf_dir):
    """Records written as Kafka-shaped files and replayed as a stream."""
    folder = scratch_path(spark, "replay")
    tb.record_batch(spark, sf_dir).write.parquet(f"{folder}/records")
    replayed = event_source.replay_stream(spark, f"{folder}/records")
    _drain(replayed, "parquet", folder)
    return spark.read.schema(schemas.KAFKA_RECORD).parquet(f"{folder}/out").select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    )


def _drain(rows: DataFrame, fmt: str, folder: str) -> None:
    sink = jobs.start_file_sink(
        rows, fmt, f"{folder}/out", f"{folder}/checkpoint", jobs.AVAILABLE_NOW
    )
    jobs.finish(sink)


@query
def stream_parse(spark, sf_dir):
    folder = scratch_path(spark, "stream_parse")
    reviews = events.decode(events.open_envelope(tb.record_stream(spark, sf_dir)))
    _drain(reviews, "parquet", folder)
    return spark.read.schema(reviews.schema).parquet(f"{folder}/out")


@query
def stream_bronze(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    jobs.finish(jobs.start_bronze(tb.record_stream(spark, sf_dir), layout, jobs.AVAILABLE_NOW))
    return event_source.read_bronze(spark, layout.bronze_stream)


@query
def stream_silver(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    jobs.finish(jobs.start_silver(tb.record_stream(spark, sf_dir), layout, jobs.AVAILABLE_NOW))
    return silver.read_silver(spark, layout, ["stream"])


@query
def stream_fanout(spark, sf_dir):
    """Silver of the query that has all sinks, one run of it compacted and its files gone."""
    layout = LakeLayout(scratch_path(spark, "lake"))
    folder = scratch_path(spark, "replay")
    records = tb.record_batch(spark, sf_dir)
    for third in range(3):
        records.where(F.col("offset") % 3 == third).write.mode("append").parquet(folder)
        stream = event_source.replay_stream(spark, folder)
        jobs.finish(fanout.start_fanout(stream, layout, jobs.AVAILABLE_NOW))
        if third == 1:
            compaction.compact_stream_lane(spark, layout)
            compaction.forget_covered(spark, layout)
    return silver.read_silver(spark, layout, ["stream"])


@query
def silver_compacted(spark, sf_dir):
    """The stream lane, compacted, with more rows after that."""
    layout = LakeLayout(scratch_path(spark, "lake"))
    folder = scratch_path(spark, "replay")
    records = tb.record_batch(spark, sf_dir)
    for half in (0, 1):
        part = records.where(F.col("offset") % 2 == half)
        part.write.mode("append").parquet(folder)
        stream = event_source.replay_stream(spark, folder, files_per_trigger=4)
        jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW))
        if half == 0:
            compaction.compact_stream_lane(spark, layout)
    return silver.read_silver(spark, layout, ["stream"])


@query
def stream_restart(spark, sf_dir):
    """Run, stop and run again on the same checkpoint: nothing is read twice."""
    layout = LakeLayout(scratch_path(spark, "lake"))
    for _ in range(2):
        records = tb.record_stream(spark, sf_dir)
        jobs.finish(jobs.start_silver(records, layout, jobs.AVAILABLE_NOW))
    return silver.read_silver(spark, layout, ["stream"])


def _result_of(spark, result: DataFrame, name: str) -> DataFrame:
    folder = scratch_path(spark, name)
    started = jobs.start_result_table(
        result,
        f"{folder}/out",
        f"{folder}/checkpoint",
        jobs.AVAILABLE_NOW,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    jobs.finish(started)
    return jobs.latest_result(spark, f"{folder}/out", result.schema)


@query
def stream_sentiment_counts(spark, sf_dir):
    counts = jobs.sentiment_counts(tb.record_stream(spark, sf_dir))
    return _result_of(spark, counts, "sentiment_counts")


@query
def stream_product_scores(spark, sf_dir):
    scores = jobs.product_scores(tb.record_stream(spark, sf_dir))
    return _result_of(spark, scores, "product_scores")


def _running(spark, sf_dir, report, name: str, schema: str) -> DataFrame:
    """Several micro-batches, each stored as its sums only, some of them added up on the way."""
    folder = scratch_path(spark, name)
    tb.record_batch(spark, sf_dir).repartition(6, "offset").write.parquet(f"{folder}/records")
    records = event_source.replay_stream(spark, f"{folder}/records", files_per_trigger=1)
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    jobs.finish(running.start_running(records, report, out, checkpoint, jobs.AVAILABLE_NOW))
    return running.running_result(spark, report, out, schema)


@query
def stream_sentiment_running(spark, sf_dir):
    schema = "sentiment string, review_count long"
    return _running(spark, sf_dir, running.sentiment_report(), "sentiment_running", schema)


@query
def stream_product_running(spark, sf_dir):
    schema = "product_id string, review_count long, average_score double"
    return _running(spark, sf_dir, running.product_report(), "product_running", schema)


@query
def stream_enrich_catalog(spark, sf_dir):
    """Each micro-batch joined to the catalog as it is then."""
    folder = scratch_path(spark, "stream_enrich")
    reviews = events.decode(events.open_envelope(tb.record_stream(spark, sf_dir)))
    reviews = reviews.select("offset", "product_id", "score")
    started = jobs.start_enriched(
        reviews,
        lambda: tb.catalog(spark, sf_dir),
        f"{folder}/out",
        f"{folder}/checkpoint",
        jobs.AVAILABLE_NOW,
    )
    jobs.finish(started)
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@query
def stream_dedup(spark, sf_dir):
    """Every event sent twice; each with an id arrives once."""
    folder = scratch_path(spark, "stream_dedup")
    reviews = events.decode(events.open_envelope(tb.record_stream(spark, sf_dir)))
    twice = reviews.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = dedup.drop_stream_repeats(twice, "kafka_timestamp", "10 minutes")
    with jobs.state_partition_number(spark, spark.sparkContext.defaultParallelism):
        _drain(once, "parquet", folder)
    return spark.read.schema(once.schema).parquet(f"{folder}/out")
