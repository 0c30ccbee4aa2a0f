"""Every named query against its SQL counterpart."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as driver  # noqa: E402

from opinlake.workload import queries as workload  # noqa: E402
from opinlake.workload import tables  # noqa: E402
from opinlake.workload.oracle import ORACLE  # noqa: E402
from opinlake.workload.queries import QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def plain(value):
        if isinstance(value, float) and math.isnan(value):
            return "None"
        return repr(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    frame = driver.queries()[name](spark, DATA)
    cursor = duck.execute(driver.oracle_sql()[name])
    expected_columns = [column[0] for column in cursor.description]
    assert sorted(frame.columns) == sorted(expected_columns)
    expected = comparable(expected_columns, cursor.fetchall())
    assert comparable(frame.columns, frame.collect()) == expected
    assert expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["product_id", "review_count", "average_score", "product_name"]
    assert result.count() == 10


def test_the_package_imports_without_a_session():
    code = "import __spark_entry__ as d; print(len(d.queries()))"
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True
    )
    assert int(done.stdout) > 70


def test_no_writer_of_a_csv_export_has_the_whole_table(spark, monkeypatch):
    # A path of its own: exports are kept by path.
    monkeypatch.setattr(workload, "LARGE_FILE_BYTES", 50_000, raising=False)
    rows = QUERIES["csv_scan_split"](spark, "/root/../root/testdata/sf0.001")
    assert rows.select("*").count() == QUERIES["csv_scan"](spark, DATA).count()
    key = (spark.sparkContext.applicationId, "/root/../root/testdata/sf0.001", "history_one_csv")
    assert len(list(Path(workload._written[key]).glob("part-*.csv"))) > 1


def test_a_stream_of_few_files_is_decoded_by_every_core(spark):
    plan = tables.record_stream(spark, DATA)._jdf.queryExecution().logical().toString()
    assert "Repartition" in plan


def test_audits_of_loads_need_no_stream(spark, monkeypatch):
    def never(*_, **__):
        raise AssertionError("audits are of the batch lane")

    monkeypatch.setattr(workload.jobs, "start_silver", never)
    monkeypatch.setattr(workload.partials, "refresh_partials", never)
    # A path of its own: lakes are kept by path.
    audits = QUERIES["load_audits"](spark, "/root/../root/testdata/sf0.001").first()
    assert audits == QUERIES["load_audits"](spark, DATA).first()
    rows = workload.history(spark, DATA)
    kept = workload.cleaning.clean_history(rows).count()
    assert tuple(audits) == (rows.count(), kept, kept)
