import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinlake.functions import review as rv
from opinlake.functions import text as tx
from opinlake.functions import times


def evaluate(spark, expression, values, kind="string"):
    rows = [(i, value) for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, text {kind}")
    shown = frame.select("i", expression(F.col("text")).alias("v")).orderBy("i")
    return [row.v for row in shown.collect()]


def test_sentiment_follows_the_score(spark):
    scores = [5, 4, 3, 2, 1, None]
    expected = ["positive", "positive", "neutral", "negative", "negative", "negative"]
    assert evaluate(spark, rv.sentiment_of, scores, "int") == expected


def test_word_count_trims_blanks_only(spark):
    texts = ["a b", "\na b", "\n\t", "a b\n", "", None, "   ", "  two   words  "]
    assert evaluate(spark, tx.word_count, texts) == [2, 3, 2, 3, 0, 0, 0, 2]


def test_strict_word_count_ignores_outer_white_space(spark):
    texts = ["a b", "\na b", "\n\t", "a b\n", "", None, "\u00a0x\u2003y\u00a0", " "]
    assert evaluate(spark, tx.word_count_strict, texts) == [2, 2, 0, 2, 0, 0, 2, 0]


def test_text_length_counts_characters(spark):
    assert evaluate(spark, tx.text_length, ["abc", "été", "𝄞x", "", None]) == [3, 3, 2, 0, 0]


@pytest.mark.parametrize(
    ("text", "negative", "positive"),
    [
        ("This is excellent and fresh", False, True),
        ("The greatness was debatable", False, False),
        ("bad_", False, False),
        ("ébad", False, False),
        ("BAD", True, False),
        ("not bad, quite tasty", True, True),
        ("bad\u0301", False, False),
        ("bad", True, False),
        ("(awful)", True, False),
        ("bad1", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_keywords_are_whole_words(spark, text, negative, positive):
    assert evaluate(spark, lambda c: tx.mentions_any(c, tx.NEGATIVE_WORDS), [text]) == [negative]
    assert evaluate(spark, lambda c: tx.mentions_any(c, tx.POSITIVE_WORDS), [text]) == [positive]


def test_keywords_may_hold_special_characters(spark):
    words = ("c++", "a.b")
    texts = ["I like C++ a lot", "axb", "a.b"]
    assert evaluate(spark, lambda c: tx.mentions_any(c, words), texts) == [True, False, True]


def test_row_filter_keeps_missing_products(spark):
    ids = ["e2e-1", None, "P001", "E2E", "xE2E"]
    assert evaluate(spark, rv.is_counted, ids) == [False, True, True, False, True]


def test_blank_and_visible_texts(spark):
    texts = [" ", "\n", "\u00a0", "x", "", None]
    assert evaluate(spark, tx.has_nonblank_text, texts) == [False, True, True, True, False, False]
    assert evaluate(spark, tx.has_visible_text, texts) == [False] * 3 + [True] + [False] * 2


def test_product_label_falls_back(spark):
    values = [("Tea", "P1"), ("", "P2"), (None, "P3"), (None, ""), (None, None)]
    frame = spark.createDataFrame(values, "name string, id string")
    labels = frame.select(rv.product_label(F.col("name"), F.col("id")).alias("v")).collect()
    assert [row.v for row in labels] == ["Tea", "P2", "P3", "Unknown product", "Unknown product"]


def test_iso_text_and_back(spark):
    frame = spark.sql(
        "SELECT timestamp'2026-01-01 00:00:00' AS a, timestamp'2026-01-01 00:00:00.000120' AS b"
    ).select(times.to_iso_text(F.col("a")).alias("a"), times.to_iso_text(F.col("b")).alias("b"))
    row = frame.first()
    assert row.a == "2026-01-01T00:00:00+00:00"
    assert row.b == "2026-01-01T00:00:00.000120+00:00"
    back = evaluate(spark, times.from_iso_text, [row.a, row.b, "soon", "", None])
    assert [str(v) for v in back[:2]] == ["2026-01-01 00:00:00", "2026-01-01 00:00:00.000120"]
    assert back[2:] == [None, None, None]


def test_epoch_seconds_out_of_range_become_null(spark):
    seconds = [0, 1767225600, 10**18, -(10**18), None]
    values = evaluate(spark, times.from_epoch_seconds, seconds, "bigint")
    assert [v is None for v in values] == [False, False, True, True, True]


def test_epoch_seconds_do_not_depend_on_the_zone(spark):
    # 06:30 UTC lies in the hour that New York repeats on that day.
    second = 1762064999
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        shown = spark.range(1).select(
            F.unix_seconds(times.from_epoch_seconds(F.lit(second).cast("bigint"))).alias("v")
        )
        assert shown.first().v == second
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plain_values(spark):
    frame = spark.sql(
        "SELECT CAST(1.5 AS DECIMAL(5, 2)) AS d, date'2026-01-02' AS t,"
        " timestamp'2026-01-02 03:04:05' AS s, timestamp'2026-01-02 03:04:05.5' AS m, 'x' AS x"
    )
    row = times.to_plain_values(frame).first()
    expected = (1.5, "2026-01-02", "2026-01-02T03:04:05", "2026-01-02T03:04:05.500000", "x")
    assert tuple(row) == expected


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(alphabet=st.sampled_from("ab \t\n\u00a0\u2003é_1"), max_size=12),
        min_size=40,
        max_size=40,
    )
)
def test_measures_agree_with_python(spark, texts):
    strict = evaluate(spark, tx.word_count_strict, texts)
    assert strict == [len(text.split()) for text in texts]
    visible = evaluate(spark, tx.has_visible_text, texts)
    assert visible == [bool(text.strip()) for text in texts]
    assert evaluate(spark, tx.strip, texts) == [text.strip() for text in texts]
    nonblank = evaluate(spark, tx.has_nonblank_text, texts)
    counts = evaluate(spark, tx.word_count, texts)
    # What the reports rely on: a word count of zero means a blank text.
    assert [count > 0 for count in counts] == nonblank


def test_wide_space_pattern_and_characters_agree():
    import re

    # Python's own notion of white space over the whole range.
    python_space = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert python_space == set(tx.WIDE_SPACE_CHARS)
    translated = re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{m.group(1)}", tx.WIDE_SPACE)
    assert all(re.fullmatch(f"[{translated}]", char) for char in tx.WIDE_SPACE_CHARS)
