import re
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest

from opinlake.llm import bpe, queries, toxicity
from tests.llm.conftest import prose
from tests.llm.test_filters import words_of
from tests.llm.test_near_copies import first_of_each

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    passage = prose(5000, 30)
    rows, labels = [], []
    for k in range(240):
        toxic = k % 6 == 0
        rows.append((k, prose(k, 90) + (" you stupid worthless idiot" if toxic else "")))
        labels.append((k, 1, int(toxic)))
    rows += [(300, rows[1][1]), (301, rows[2][1] + "\n"), (302, rows[7][1].replace("the", "teh", 1))]
    rows += [(310, prose(3000, 80)), (311, prose(3000, 79))]
    rows += [(303, f"{prose(900, 50)} {passage}"), (304, None), (305, ""), (None, "no id")]
    spark.createDataFrame(
        [(i, t, "en", "src0", len(t or "")) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def test_each_stage_decides_on_what_the_one_before_kept(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, tables), "test_stage")
        assert docs.columns == names
        seen[name] = before - {r["doc_id"] for r in docs.collect()}
    assert seen["toxicity"] >= {0, 6, 12} and not seen["toxicity"] & {1, 2, 7, 303, None}
    assert seen["exact dedup"] == {2, 300, 305}
    assert seen["decontamination"] == {303}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def without_toxic(spark, rows, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    return [(i, t) for i, t in rows if model.score([(t or "").encode()])[0] < toxicity.THRESHOLD]


def without_copies(rows):
    """The longest of equal texts, then the smallest id."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\\x20\\x09-\\x0D]", "", t or ""), []).append((i, t))
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def without_passages(rows, items):
    """No ten words in a row of an item, or all of a shorter one."""
    windows = set()
    for text in items:
        own = words_of(text)
        windows |= {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9) if own else 0)}
    sizes = {len(w) for w in windows}

    def clean(text):
        own = words_of(text)
        return not any(tuple(own[k : k + n]) in windows for n in sizes for k in range(len(own) - n + 1))

    return [(i, t) for i, t in rows if clean(t)]


def test_run_equals_the_definitions(spark, tables, rows_of):
    """Every stage by its definition over all rows, near copies over all pairs of five-word shingle sets."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    left = without_toxic(spark, rows, tables)
    left = without_copies(left)
    near = first_of_each(left)
    assert {i for i, _ in left} - {i for i, _ in near} == {302, 311}
    left = without_passages(near, items)
    assert {i for i, _ in near} - {i for i, _ in left} == {303}
    expected = bpe.round_trip(spark.createDataFrame(left, "doc_id long, text string"))
    assert rows_of(queries.QUERIES["pipeline"](spark, tables)) == rows_of(expected)


def test_rows_of_one_id_or_none_are_decided_by_their_own_text(spark, tables):
    passage = spark.read.parquet(f"{tables}/benchmark.parquet").first()["text"]
    insult = prose(60, 90) + " you stupid worthless idiot"
    rows = [(None, passage), (1, passage), (1, prose(61, 40)), (None, prose(62, 40)), (None, insult), (400, insult), (400, prose(63, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.remove_contaminated(spark, docs, tables).collect()}
    assert kept == set(rows[2:])
    known = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    kept = corpus_pipeline.remove_toxic(spark, known.unionAll(docs.where("doc_id IS NULL OR doc_id = 400")), tables)
    kept = {r["text"] for r in kept.collect()}
    assert insult not in kept and {rows[3][1], rows[6][1], passage} <= kept


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, rows_of, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    frame = queries.QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame, *columns) == sorted((tuple(r) for r in cursor.fetchall()), key=repr)


def test_queries_are_named_after_their_operators():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
