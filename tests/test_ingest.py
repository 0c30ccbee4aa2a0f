import base64
import random
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.operators import cleaning, dedup
from opinlake.plans import batch_ingest, loads
from opinlake.plans.batch_ingest import ingest_history
from opinlake.session import with_settings
from opinlake.sources.history_csv import read_history_csv, read_sample_csv
from opinlake.sources.silver import (
    MissingLane,
    create_external_tables,
    fetch_one,
    fetch_report,
    first_rows,
    list_tables,
    read_silver,
    silver_preview,
    table_peek,
)
from opinlake.workload import tables
from tests.sample import HEADER, ROWS, csv_text


@pytest.fixture
def sample_csv(tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(csv_text(), encoding="utf-8")
    return str(path)


def raw(spark, *rows):
    names = ("Id", "ProductId", "UserId", "Score", "Time", "Text")
    full = [
        tuple(dict(zip(names, row, strict=True)).get(c) for c in schemas.HISTORY_CSV.fieldNames())
        for row in rows
    ]
    return spark.createDataFrame(full, schemas.HISTORY_CSV)


GOOD = ("1", "P1", "U1", "5", "1767225600", "fine")


def test_quoted_fields_may_hold_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text(
        f'{HEADER}\n1,P1,U1,N,1,2,5,1767225600,S,"good ""quoted"" text\nsecond line"\n'
    )
    rows = read_history_csv(spark, str(path)).collect()
    assert [row.Text for row in rows] == ['good "quoted" text\nsecond line']


@pytest.mark.parametrize(
    ("change", "kept"),
    [
        ({}, True),
        ({3: "oops"}, False),
        ({3: "9"}, False),
        ({3: "0"}, False),
        ({3: "2.7"}, False),
        ({3: None}, False),
        ({2: "  "}, False),
        ({1: ""}, False),
        ({5: " "}, False),
        ({5: "\n"}, True),
        ({4: "later"}, False),
        ({0: "n/a"}, False),
        ({0: None}, False),
    ],
)
def test_cleaning(spark, change, kept):
    row = tuple(change.get(i, value) for i, value in enumerate(GOOD))
    assert (cleaning.clean_history(raw(spark, row)).count() == 1) is kept


def test_normalized_rows_have_the_silver_schema(spark):
    rows = cleaning.history_to_silver(cleaning.clean_history(raw(spark, GOOD)))
    assert [(f.name, f.dataType) for f in rows.schema.fields] == [
        (f.name, f.dataType) for f in schemas.SILVER.fields
    ]
    row = rows.first()
    assert row.kafka_key is None and row.offset is None
    assert (row.source, row.review_id, row.score) == ("amazon_csv", "1", 5)
    assert row.created_at == datetime(2026, 1, 1)


def test_ingest_writes_both_layers_and_counts(spark, sample_csv, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    broken = tmp_path / "broken.csv"
    broken.write_text(csv_text() + "17,P1,U1,N,1,2,oops,1767225600,S,text\n")
    audit = ingest_history(read_history_csv(spark, str(broken)), layout)
    assert (audit.raw_rows, audit.cleaned_rows, audit.written_rows) == (17, 16, 16)
    assert spark.read.json(layout.bronze_batch).count() == 16
    silver = read_silver(spark, layout, ["batch"])
    flags = silver.orderBy(silver.review_id.cast("int")).collect()
    assert [(r.has_negative_keywords, r.has_positive_keywords) for r in flags] == [
        row[3] for row in ROWS
    ]


def test_what_a_load_stores_is_compressed_whatever_the_session(spark, sample_csv, tmp_path):
    layout, work = LakeLayout(str(tmp_path / "lake")), tmp_path / "gz"
    ingest_history(read_history_csv(spark, sample_csv), layout)
    files = list((tmp_path / "lake/silver").rglob("*.parquet"))
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert codecs == {"ZSTD"}
    # A large compressed file has no ranges: it is read as it is, not in parts.
    raw = read_history_csv(spark, sample_csv)
    tables.write_history_csv(raw.coalesce(1), str(work), tables.COMPRESSED_CSV)
    assert [p.suffix for p in work.glob("part-*")] == [".gz"]
    with with_settings(spark, {"spark.sql.files.maxPartitionBytes": "64"}):
        again = read_history_csv(spark, str(work))
        assert "MapInArrow" not in again._jdf.queryExecution().toString()
        assert sorted(map(str, again.collect())) == sorted(map(str, raw.collect()))


def test_a_second_run_appends_and_dedup_undoes_it(spark, sample_csv, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    for _ in range(2):
        ingest_history(read_history_csv(spark, sample_csv), layout)
    silver = read_silver(spark, layout, ["batch"])
    assert silver.count() == 32
    assert dedup.drop_repeats(silver).count() == 16


def test_missing_lanes_are_errors(spark, sample_csv, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    for lanes, optional in ((["batch"], []), (["batch", "stream"], ["batch", "stream"])):
        with pytest.raises(MissingLane):
            read_silver(spark, layout, lanes, optional)
    ingest_history(read_history_csv(spark, sample_csv), layout)
    with pytest.raises(MissingLane, match="stream"):
        read_silver(spark, layout)
    rows = read_silver(spark, layout, optional=["stream"])
    assert rows.count() == 16
    assert rows.columns == schemas.SILVER.fieldNames()


def test_the_input_is_parsed_once_and_dealt_out_by_time(spark, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    header = csv_text().splitlines()[0]
    lines = [f"{n},P{n % 3},U1,N,1,2,{1 + n % 5},{1767225600 + n * 977 % 4000},S,text" for n in range(400)]
    path = tmp_path / "many.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    audit = ingest_history(read_history_csv(spark, str(path)), layout)
    assert (audit.raw_rows, audit.cleaned_rows, audit.written_rows) == (400, 400, 400)
    rows = read_silver(spark, layout, ["batch"]).withColumn("file", F.input_file_name())
    ranges = rows.groupBy("file").agg(F.min("created_at"), F.max("created_at")).collect()
    spans = sorted((r[1], r[2]) for r in ranges)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_numbers_written_as_doubles_and_rejects(spark):
    rows = [
        ("1.0", "P1", "U", "5.0", "1346976000.0", "t"),
        ("2", "P1", "U", "2.7", "1", "t"),
        ("3", "P1", "U", "5", "999999999999", "t"),
        ("4", "P1", "U", "9.0", "1", "t"),
        ("5", " ", "U", "4", "1", "t"),
        ("6", "P1", None, "4", "1", "t"),
        ("x", "P1", "U", "4", "1", "t"),
        ("7", "P1", "U", "4", "soon", "t"),
    ]
    names = "Id string, ProductId string, UserId string, Score string, Time string, Text string"
    raw = spark.createDataFrame(rows, names)
    for name in ("ProfileName", "HelpfulnessNumerator", "HelpfulnessDenominator", "Summary"):
        raw = raw.withColumn(name, F.lit(None).cast("string"))
    kept = cleaning.history_to_silver(cleaning.clean_history(raw)).collect()
    assert [(r.review_id, r.score, str(r.created_at)) for r in kept] == [
        ("1", 5, "2012-09-07 00:00:00")
    ]
    reasons = {r.Id: r.reason for r in cleaning.rejected_history(raw).collect()}
    assert reasons == {
        "2": "Score is no whole number",
        "3": "Time is outside the years 1 to 9999",
        "4": "Score is out of range",
        "5": "ProductId is blank",
        "6": "UserId is missing",
        "x": "Id is no whole number",
        "7": "Time is no whole number",
    }


def test_dedup_keeps_rows_without_an_id_and_the_earliest(make_silver):
    from datetime import datetime

    day = lambda n: datetime(2026, 1, n)
    silver = make_silver(
        [
            {"review_id": "a", "source": "web", "created_at": day(3), "text": "late"},
            {"review_id": "a", "source": "web", "created_at": day(1), "text": "early"},
            {"review_id": "a", "source": "web", "created_at": None, "text": "no time"},
            {"review_id": "a", "source": None, "text": "other source"},
            {"review_id": "a", "source": None, "text": "other source"},
            {"review_id": None, "source": "web", "text": "one"},
            {"review_id": None, "source": "web", "text": "one"},
        ]
    )
    once = dedup.drop_repeats(silver)
    assert once.columns == silver.columns
    assert sorted(r.text for r in once.collect()) == ["early", "one", "one", "other source"]


def test_dedup_in_rounds_frees_each_before_the_next(make_silver, spark, monkeypatch):
    """Of a table beyond a round's size, no round but the last is left to be shuffled with the others."""
    rows = [
        {"review_id": None if k % 11 == 0 else str(k % 40), "source": [None, "web", "x"][k % 3], "text": f"t{k % 7}"}
        for k in range(400)
    ]
    silver = make_silver(rows)
    silver = silver.unionAll(silver)
    rows_of = lambda frame: sorted(map(str, frame.collect()))
    assert dedup.drop_repeats_in_rounds(silver, round_bytes=1 << 40).inputFiles() == []
    seen = []
    whole = dedup.materialize

    def watched(part, name):
        seen.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        return whole(part, name)

    monkeypatch.setattr(dedup, "materialize", watched)
    once = dedup.drop_repeats_in_rounds(silver, round_bytes=10_000, most_rounds=3)
    assert seen == ["true", "true"] and once.inputFiles()
    assert rows_of(once) == rows_of(dedup.drop_repeats(silver))
    assert once.columns == silver.columns
    nobody = silver.where("review_id IS NULL")
    assert rows_of(dedup.drop_repeats_in_rounds(nobody, round_bytes=1)) == rows_of(nobody)


def test_the_preview_skips_rows_without_an_offset(make_silver, spark):
    silver = make_silver([{"review_id": str(n), "text": "t"} for n in range(30)])
    silver = silver.withColumn("offset", F.when(F.col("review_id").cast("int") < 25, F.col("review_id").cast("long")))
    assert [r.offset for r in silver_preview(silver, 3).collect()] == [24, 23, 22]
    assert [r.offset for r in silver_preview(silver, 28).collect()][24:] == [0, None, None, None]


def test_sample_read_is_strict(spark, sample_csv, tmp_path):
    rows = read_sample_csv(spark, sample_csv)
    assert rows.columns == list(schemas.OPINION_COLUMNS)
    assert {row.source for row in rows.collect()} == {"sample_csv"}
    for number, bad in enumerate(("17,P1,U1,N,1,2,oops,1,S,t", "17,P1,U1,N,1,2,,1,S,t")):
        path = tmp_path / f"bad{number}.csv"
        path.write_text(csv_text() + bad + "\n")
        with pytest.raises((PySparkException, Py4JJavaError)):
            read_sample_csv(spark, str(path)).collect()


def test_external_tables(spark, sample_csv, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    ingest_history(read_history_csv(spark, sample_csv), layout)
    view = create_external_tables(spark, layout, "shop_test")
    assert create_external_tables(spark, layout, "shop_test") == view
    assert spark.table(view).count() == 16
    assert spark.table("shop_test.reviews_enriched_stream").count() == 0
    assert spark.table(view).columns == schemas.SILVER.fieldNames()
    assert "reviews_enriched_batch" in list_tables(spark, "shop_test")
    peek = table_peek(spark, view).collect()
    assert [(r.col_name, r.row_count) for r in peek] == [
        (name, 16) for name in schemas.SILVER.fieldNames()
    ]
    assert first_rows(spark, view).count() == 10
    total = spark.sql(f"SELECT count(*) AS n, avg(score) AS a FROM {view}")
    assert fetch_one(total) == {"n": 16, "a": 3.5625}
    assert fetch_one(total.where("n < 0")) == {}
    assert silver_preview(spark.table(view), 3).count() == 3
    assert len(fetch_report(spark.table(view), 16)) == 16
    with pytest.raises(ValueError):
        fetch_report(spark.table(view), 15)


@pytest.mark.parametrize("dies_at", ["silver", "audit", "marker"])
def test_a_load_that_dies_is_repeated_and_leaves_no_row_twice(
    spark, sample_csv, tmp_path, monkeypatch, dies_at
):
    layout = LakeLayout(str(tmp_path / "lake"))
    raw_rows = read_history_csv(spark, sample_csv)
    first = ingest_history(raw_rows, layout, "day-1")

    def crash(*_):
        raise OSError("lost")

    broken = {
        "silver": (batch_ingest, "history_to_silver"),
        "audit": (batch_ingest.IngestAudit, "to_frame"),
        "marker": (batch_ingest, "publish_load"),
    }[dies_at]
    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(*broken, crash)
        ingest_history(raw_rows, layout, "day-2")
    # Whatever it has left, readers see the load before it only.
    view = create_external_tables(spark, layout, f"shop_{dies_at}")
    assert read_silver(spark, layout, ["batch"]).count() == spark.table(view).count() == 16
    assert loads.load_audits(spark, layout).count() == 1
    for _ in range(2):
        assert ingest_history(raw_rows, layout, "day-2") == first
    silver = read_silver(spark, layout, ["batch"])
    assert silver.columns == schemas.SILVER.fieldNames() and silver.count() == 32
    view = create_external_tables(spark, layout, f"shop_{dies_at}")
    assert spark.table(view).count() == 32
    assert spark.read.json(layout.bronze_batch).count() == 32
    audits = {r.load: r.written_rows for r in loads.load_audits(spark, layout).collect()}
    assert audits == {"day-1": 16, "day-2": 16}


def test_load_ids_are_names(spark, sample_csv, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    for bad in ("", "a/b", "..", "x=1"):
        with pytest.raises(ValueError):
            ingest_history(read_history_csv(spark, sample_csv), layout, bad)
    assert loads.load_audits(spark, layout).count() == 0


@pytest.mark.parametrize(
    ("text", "number"),
    [("5", 5), ("5.0", 5), (" 7 ", 7), ("+3", 3), ("2.7", None), ("1e3", 1000), ("", None),
     ("oops", None), ("9" * 30, None), ("-4.000", -4), (None, None), ("4.", 4)],
)
def test_whole_numbers(spark, text, number):
    row = spark.createDataFrame([(text,)], "t string").select(cleaning.whole_number(F.col("t"), "bigint"))
    assert row.first()[0] == number


def test_a_stretch_of_long_texts_is_dealt_out(spark, tmp_path, monkeypatch):
    """Ranges hold equally many rows: with a number that does not grow, all long texts fell into one."""
    monkeypatch.setattr(batch_ingest, "RANGE_ROWS", 30, raising=False)
    rnd = random.Random(3)
    rows = [("1", "P1", "U1", "5", str(1000 + k), "short") for k in range(400)]
    rows += [("2", "P1", "U1", "5", str(9000 + k), base64.b64encode(rnd.randbytes(250_000)).decode()) for k in range(120)]
    layout = LakeLayout(str(tmp_path / "lake"))
    audit = ingest_history(raw(spark, *rows), layout)
    assert audit.written_rows == 520
    silver = read_silver(spark, layout, ["batch"])
    files = silver.where("text_length > 10").select(F.input_file_name()).distinct().count()
    assert files > 1
    bronze = [p.name for p in (tmp_path / "lake").rglob("part-*") if "bronze" in str(p)]
    assert bronze and all(name.endswith(".json.gz") for name in bronze)
