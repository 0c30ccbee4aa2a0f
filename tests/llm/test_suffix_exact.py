from opinlake.llm import suffix_dedup
from tests.llm.conftest import prose
from tests.llm.test_dedup import repeated_words


def test_partners_that_are_far_apart_in_a_large_group(spark):
    """Many documents hold one notice before texts of their own; pairs of them share what stands
    before it as well, too little of it to be next to each other in either order."""
    notice = prose(4000, 25)
    rows = [(k, f"{prose(4100 + k, 45)} {notice} {prose(5100 + k, 45)}") for k in range(400)]
    for pair in range(20):
        shared = prose(6000 + pair, 40)
        # Others share the nearest words before the notice, so the past order is crowded, too.
        rows += [(1000 + 2 * pair + k, f"{prose(6100 + 2 * pair + k, 9)} {shared} {notice} {prose(6300 + 2 * pair + k, 45)}") for k in (0, 1)]
        near = " ".join(shared.split()[-20:])
        rows += [(2000 + 10 * pair + k, f"{prose(7000 + 10 * pair + k, 30)} {near} {notice}") for k in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = suffix_dedup.repeated_passages(frame).collect()
    got = {(r["doc_id"], p) for r in found for p in range(r["start_word"], r["end_word"])}
    assert got == repeated_words(rows)
    assert {r["doc_id"] for r in found} == set(range(1000, 1040))


def test_large_group_over_several_batches(spark):
    """The order by what comes before holds in one batch only."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        test_partners_that_are_far_apart_in_a_large_group(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
