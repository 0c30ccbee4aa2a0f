import os
import subprocess
import sys
from pathlib import Path

import pytest

from opinlake import schemas, session
from opinlake.layout import LakeLayout, StreamSettings, as_read_uri, history_csv_path


def test_paths_hang_below_the_base():
    layout = LakeLayout.from_env({"HDFS_BASE_PATH": "hdfs://names:9000/shop/"})
    assert layout.bronze_stream == "hdfs://names:9000/shop/bronze/reviews_raw"
    assert layout.bronze_batch == "hdfs://names:9000/shop/bronze/amazon_reviews_raw"
    assert layout.silver == "hdfs://names:9000/shop/silver/reviews_enriched"
    assert layout.checkpoint("x") == "hdfs://names:9000/shop/checkpoints/x"
    assert layout.default_fs == "hdfs://names:9000"
    assert LakeLayout("/data/lake").default_fs is None


def test_lanes_have_folders_of_their_own():
    layout = LakeLayout("/lake")
    assert layout.silver_batch != layout.silver_stream
    assert {os.path.dirname(p) for p in (layout.silver_batch, layout.silver_stream)} == {
        layout.silver
    }


def test_read_uri():
    assert as_read_uri("hdfs://names/x.csv") == "hdfs://names/x.csv"
    assert as_read_uri("file:///x.csv") == "file:///x.csv"
    assert as_read_uri("/data/x.csv") == "file:///data/x.csv"
    assert as_read_uri("x.csv") == f"file://{os.getcwd()}/x.csv"
    assert history_csv_path({"AMAZON_REVIEWS_CSV": "/a/b.csv"}) == "file:///a/b.csv"


def test_stream_settings():
    defaults = StreamSettings.from_env({})
    assert (defaults.brokers, defaults.topic) == ("localhost:9092", "reviews")
    assert defaults.trigger == {"processingTime": "30 seconds"}
    assert defaults.fail_on_data_loss is False
    assert defaults.starting_offsets == "latest"
    changed = StreamSettings.from_env(
        {
            "KAFKA_BOOTSTRAP_SERVERS": "b:1",
            "KAFKA_TOPIC": "t",
            "SPARK_KAFKA_FAIL_ON_DATA_LOSS": "true",
            "SPARK_STREAM_TRIGGER_SECONDS": "5",
        }
    )
    assert (changed.brokers, changed.topic, changed.trigger_seconds) == ("b:1", "t", 5)
    assert changed.fail_on_data_loss is True
    bad = StreamSettings.from_env({"SPARK_STREAM_TRIGGER_SECONDS": "soon"})
    assert bad.trigger_seconds == 30


def test_required_columns_and_silver_tail():
    assert set(schemas.REQUIRED_HISTORY_COLUMNS) <= set(schemas.HISTORY_CSV.fieldNames())
    assert len(schemas.SILVER) == 17
    assert schemas.SILVER.fieldNames()[-4:] == [
        "text_length",
        "word_count",
        "has_negative_keywords",
        "has_positive_keywords",
    ]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_a_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())


def test_materialized_frames_read_from_files(spark):
    frame = session.materialize(spark.range(5), "numbers")
    assert frame.count() == 5
    assert frame.inputFiles()


def test_few_scan_tasks_are_spread_and_many_are_not(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(one)
    spark.range(100).repartition(40).write.parquet(many)
    spread = session.spread(spark.read.parquet(one))
    assert "Exchange" in spread._jdf.queryExecution().executedPlan().toString()
    untouched = spark.read.parquet(many)
    assert session.spread(untouched) is untouched


def test_a_local_cluster_needs_a_shared_folder_too():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())


def test_submitted_settings_win():
    """In a process of its own, as settings are submitted before there is a session."""
    code = (
        "from opinlake.session import build_session\n"
        "s = build_session('t', 'local[1]', {'spark.ui.enabled': 'false'})\n"
        "print(s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.files.maxPartitionBytes'))"
    )
    root = str(Path(__file__).resolve().parents[1])
    submitted = "--conf spark.sql.shuffle.partitions=64 pyspark-shell"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": submitted},
    )
    assert done.stdout.split()[-2:] == ["64", "256m"]


def test_settings_of_the_file_system_and_offsets():
    env = {"HDFS_BASE_PATH": "/lake", "HDFS_DEFAULT_FS": "hdfs://names:9000"}
    assert LakeLayout.from_env(env).default_fs == "hdfs://names:9000"
    env = {"KAFKA_STARTING_OFFSETS": "earliest", "KAFKA_MAX_OFFSETS_PER_TRIGGER": "500"}
    settings = StreamSettings.from_env(env)
    assert (settings.starting_offsets, settings.max_offsets_per_trigger) == ("earliest", 500)
    assert StreamSettings.from_env({}).max_offsets_per_trigger is None
