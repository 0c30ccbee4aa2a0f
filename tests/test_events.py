import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.operators import events

WHOLE = {
    "product_id": "P1",
    "user_id": "U1",
    "score": 4,
    "text": "fine\nindeed",
    "source": "web",
    "review_id": "r1",
    "created_at": "2026-01-02T03:04:05.000678+00:00",
}


def bronze(spark, *values):
    rows = [("k", value, "reviews", 0, n, datetime(2026, 1, 1)) for n, value in enumerate(values)]
    return spark.createDataFrame(rows, schemas.BRONZE_EVENT)


def without(name):
    return json.dumps({k: v for k, v in WHOLE.items() if k != name})


def changed(**values):
    return json.dumps({**WHOLE, **values})


def test_a_whole_event_is_decoded(spark):
    row = events.decode(bronze(spark, json.dumps(WHOLE))).first()
    assert row.created_at == datetime(2026, 1, 2, 3, 4, 5, 678)
    assert (row.product_id, row.score, row.text) == ("P1", 4, "fine\nindeed")


def test_bad_scores_become_null(spark):
    values = (changed(score=4.5), changed(score="4"), without("score"), "garbage", None)
    rows = events.decode(bronze(spark, *values)).orderBy("offset").collect()
    assert [row.score for row in rows] == [None] * 5
    assert [row.product_id for row in rows] == ["P1", "P1", "P1", None, None]


def test_quarantine_splits_exactly(spark):
    values = (
        json.dumps(WHOLE), "garbage", None, changed(score="4"), without("source"), "[]",
        "", "  ", "\t\n", "{}", '{"score":5}', "null", changed(text=None), without("created_at"),
    )
    rows = bronze(spark, *values)
    good = {row.offset for row in events.decode(rows, "quarantine").collect()}
    bad = {row.offset for row in events.undecodable(rows).collect()}
    assert good | bad == set(range(len(values)))
    assert not good & bad
    assert good == {0, 4}
    reasons = {row.offset: row.reason for row in events.rejected(rows).collect()}
    assert reasons[2] == "no value"
    assert {reasons[k] for k in (6, 7, 8)} == {"blank value"}
    assert (reasons[9], reasons[10]) == ("product_id is missing", "product_id is missing")
    assert (reasons[12], reasons[13]) == ("text is missing", "created_at is missing")


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        events.decode(bronze(spark), "drop")


def test_a_bad_time_becomes_null(spark):
    row = events.decode(bronze(spark, changed(created_at="soon"))).first()
    assert row.created_at is None and row.product_id == "P1"


def test_malformed_rows_stay_and_count_as_negative(spark):
    records = spark.createDataFrame(
        [(b"k", b"garbage", "reviews", 0, 0, datetime(2026, 1, 1), 0)], schemas.KAFKA_RECORD
    )
    row = events.events_to_silver(records).first()
    assert (row.product_id, row.sentiment, row.text_length, row.word_count) == (
        None, "negative", 0, 0,
    )


def test_encoding_matches_a_json_encoder(spark):
    reviews = events.decode(bronze(spark, json.dumps(WHOLE), changed(source=None, product_id="")))
    first, second = events.encode(reviews, "offset").orderBy("offset").collect()
    assert first.key == "P1"
    assert json.loads(first.value) == WHOLE
    assert second.key is None
    assert json.loads(second.value)["source"] is None


def test_defaults(spark):
    values = [("a", None, None), ("b", "U", "app")]
    rows = spark.createDataFrame(values, "id string, user_id string, source string")
    filled = {row.id: row for row in events.with_defaults(rows).collect()}
    assert (filled["a"].user_id, filled["a"].source) == ("web-client", "web")
    assert (filled["b"].user_id, filled["b"].source) == ("U", "app")
    assert uuid.UUID(filled["a"].review_id) != uuid.UUID(filled["b"].review_id)
    assert filled["a"].created_at is not None


def test_stable_ids_repeat_and_look_like_uuids(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    ids = [r.v for r in rows.select(events.stable_id(F.col("id")).alias("v")).collect()]
    again = [r.v for r in rows.select(events.stable_id(F.col("id")).alias("v")).collect()]
    assert ids == again
    assert len({uuid.UUID(value) for value in ids}) == 2
    values = [("a", "bc"), ("ab", "c"), (None, "x"), ("x", None)]
    pairs = spark.createDataFrame(values, "a string, b string")
    pair_ids = pairs.select(events.stable_id(F.col("a"), F.col("b")).alias("v"))
    assert pair_ids.distinct().count() == 4


def test_the_filter_of_the_quarantine_does_not_parse_twice(spark):
    plan = events.decode(bronze(spark, "x"), "quarantine")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json") == 1
