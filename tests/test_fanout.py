"""One read of the topic, several sinks."""

import os

import pytest
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.operators import events
from opinlake.plans import compaction, micro_batches, partials
from opinlake.session import delete_path
from opinlake.sources.events import replay_stream
from opinlake.sources.silver import MissingLane, create_external_tables, read_silver
from opinlake.streaming import fanout, jobs
from tests.test_streaming import record, same, write


@pytest.fixture
def layout(tmp_path):
    return LakeLayout(str(tmp_path / "lake"))


@pytest.fixture
def replay(spark, tmp_path):
    folder = str(tmp_path / "replay")
    for part in range(4):
        write(spark, folder, *(record(n) for n in range(part * 10, part * 10 + 10)))
    return folder


def run(spark, replay, layout, on_bad="keep", change=lambda records: records):
    stream = change(replay_stream(spark, replay, files_per_trigger=1))
    jobs.finish(fanout.start_fanout(stream, layout, jobs.AVAILABLE_NOW, on_bad))


def given(spark, replay):
    return spark.read.schema(schemas.KAFKA_RECORD).parquet(replay)


def silver_rows(spark, layout):
    return read_silver(spark, layout, ["stream"])


def test_all_sinks_equal_one_batch(spark, replay, layout):
    run(spark, replay, layout)
    assert same(silver_rows(spark, layout), events.events_to_silver(given(spark, replay)))
    assert same(micro_batches.read_fanout_bronze(spark, layout), events.open_envelope(given(spark, replay)))
    assert micro_batches.last_visible(spark, layout) == 3
    assert len([n for n in os.listdir(f"{layout.fanout}/shown") if n.isdigit()]) == 1
    assert micro_batches.read_fanout_rejects(spark, layout).count() == 0


def test_the_quarantine_is_a_sink_too(spark, replay, layout):
    run(spark, replay, layout, "quarantine")
    assert silver_rows(spark, layout).count() == 36
    bronze = events.open_envelope(given(spark, replay))
    assert same(micro_batches.read_fanout_rejects(spark, layout), events.rejected(bronze))
    with pytest.raises(ValueError):
        run(spark, replay, layout, "drop")


def test_records_are_read_once(spark, replay, layout):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(value):
        seen.add(1)
        return value

    counted = counted.asNondeterministic()
    run(spark, replay, layout, "quarantine", lambda r: r.withColumn("value", counted("value")))
    assert seen.value == 40


@pytest.mark.parametrize("sink", ["silver", "rejected", "marker"])
def test_a_crash_leaves_the_micro_batch_in_no_sink(spark, replay, layout, monkeypatch, sink):
    """Killed in the third micro-batch before a sink or the marker, then started again."""
    target = {"silver": "enrich", "rejected": "rejected", "marker": "show_batch"}[sink]
    real, calls = getattr(fanout, target), []

    def dies(*arguments):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("killed")
        return real(*arguments)

    monkeypatch.setattr(fanout, target, dies)
    with pytest.raises(Exception, match="killed"):
        run(spark, replay, layout, "quarantine")
    assert micro_batches.last_visible(spark, layout) == 1
    assert micro_batches.read_fanout_bronze(spark, layout).count() == 20
    assert silver_rows(spark, layout).count() == 18
    assert micro_batches.read_fanout_rejects(spark, layout).count() == 2
    monkeypatch.setattr(fanout, target, real)
    run(spark, replay, layout, "quarantine")
    assert micro_batches.read_fanout_bronze(spark, layout).count() == 40
    assert same(silver_rows(spark, layout), events.events_to_silver(given(spark, replay), "quarantine"))
    assert micro_batches.read_fanout_rejects(spark, layout).count() == 4


def test_a_visible_micro_batch_is_not_written_again(spark, replay, layout):
    """The marker was made, the commit of the checkpoint was not."""
    run(spark, replay, layout)
    commits = f"{layout.checkpoint(fanout.FANOUT_CHECKPOINT)}/commits"
    for name in ("3", ".3.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    before = os.stat(f"{layout.fanout_silver}/batch=3/_SUCCESS").st_mtime_ns
    run(spark, replay, layout)
    assert os.stat(f"{layout.fanout_silver}/batch=3/_SUCCESS").st_mtime_ns == before
    assert silver_rows(spark, layout).count() == 40


def test_a_lane_without_its_checkpoint_is_not_continued(spark, replay, layout):
    run(spark, replay, layout)
    delete_path(spark, layout.checkpoint(fanout.FANOUT_CHECKPOINT))
    with pytest.raises(RuntimeError, match="checkpoint"):
        run(spark, replay, layout)


def test_compaction_partials_and_tables_see_the_lane(spark, replay, layout):
    with pytest.raises(MissingLane):
        silver_rows(spark, layout)
    run(spark, replay, layout)
    assert compaction.compact_stream_lane(spark, layout) == 4
    write(spark, replay, record(40), record(41))
    run(spark, replay, layout)
    expected = events.events_to_silver(given(spark, replay))
    assert same(silver_rows(spark, layout), expected)
    assert tuple(compaction.covered_share(spark, layout).first()) == (5, 4)
    assert spark.table(create_external_tables(spark, layout, "shop_fanout")).count() == 42
    units = partials.all_units(spark, layout)
    assert (len(units.runs), len(units.files)) == (1, 1)
    # Folders that runs hold may go; rows stay, whatever comes later.
    assert compaction.forget_covered(spark, layout) == 4
    assert same(silver_rows(spark, layout), expected)
    compaction.compact_stream_lane(spark, layout)
    assert compaction.forget_covered(spark, layout) == 0  # the older manifest does not cover it
    assert same(silver_rows(spark, layout), expected)


def test_both_forms_of_the_lane(spark, replay, layout):
    run(spark, replay, layout)
    jobs.finish(jobs.start_silver(replay_stream(spark, replay), layout, jobs.AVAILABLE_NOW))
    assert silver_rows(spark, layout).count() == 80
    compaction.compact_stream_lane(spark, layout)
    assert silver_rows(spark, layout).count() == 80
