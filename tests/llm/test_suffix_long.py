"""Suffixes with equal surroundings are one row, however many there are."""

from opinlake.llm import suffix_dedup
from tests.llm.conftest import prose
from tests.llm.test_dedup import repeated_words


def test_two_long_constant_texts(spark):
    rows = [(1, "x " * 200_000), (2, "x " * 200_000), (3, prose(1, 80))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.repeated_passages(frame).collect()
    assert [tuple(r) for r in sorted(found)] == [(1, 0, 200_000, 200_000, 2), (2, 0, 200_000, 200_000, 1)]


def test_many_copies_and_near_copies(spark):
    text = prose(10, 300).split()
    rows = [(k, " ".join(text)) for k in range(60)]
    for k in range(60):  # one word differs, at another place in each
        rows.append((100 + k, " ".join([*text[: 4 * k + 20], f"own{k}", *text[4 * k + 21 :]])))
    rows += [(None, " ".join(text)), (300, None), (301, ""), (302, prose(11, 200)), (302, prose(11, 200))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = suffix_dedup.repeated_passages(frame).collect()
    got = {(r["doc_id"], p) for r in found for p in range(r["start_word"], r["end_word"])}
    assert got == repeated_words([r for r in rows if r[0] != 302])
    assert all(r["other_id"] != r["doc_id"] for r in found)


def test_a_document_with_many_places_of_one_phrase(spark):
    """The rows of one document lie between those of others, more of them than the reach."""
    phrase = prose(20, 12)
    long_ = " ".join(f"{prose(3000 + k, 30)} {phrase} {prose(4000 + k, 30)}" for k in range(120))
    shared = f"{prose(30, 30)} {phrase} {prose(31, 30)}"
    rows = [(1, long_), (2, f"{prose(32, 20)} {shared} {prose(33, 20)}"), (3, f"{prose(34, 9)} {shared}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.repeated_passages(frame).collect()
    assert {(r["doc_id"], p) for r in found for p in range(r["start_word"], r["end_word"])} == repeated_words(rows)
