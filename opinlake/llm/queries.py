"""The named queries of this subpackage over the test tables, and their SQL."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from opinlake.llm import (
    bpe,
    centroid_clusters,
    decontaminate,
    exact_dedup,
    license_scan,
    line_dedup,
    pii,
    quality_rules,
    simhash,
    spelling,
    suffix_dedup,
    token_files,
    toxicity,
)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, for sessions that were started without it on
    their Python path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="opinlake-ship-")) / "opinlake_package.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_repeats(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(documents, benchmark)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_rules.score_documents(documents, quality_rules.fit(documents, labels))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.score_documents(documents, toxicity.fit(documents, labels))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return corpus_pipeline.run(spark, sf_dir)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return centroid_clusters.clusters(vectors, centroid_clusters.fit(vectors))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return pii.span_report(documents, pii.fit(documents))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_suffix_array": op7_suffix_array,
    "op8_line_dedup": op8_line_dedup,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_centroids": op11_centroids,
    "op12_pii": op12_pii,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}


def _centroid_sql(rounds: int = 3) -> str:
    """Rounds of assigning all to all and of exact means, as a chain of common tables."""
    apart = "CAST(list_sum(list_transform(range(1, 65), lambda i: (p.v[i] - q.v[i]) * (p.v[i] - q.v[i]))) AS BIGINT)"
    assigned = f"""SELECT p.row, p.vec_id, p.v, min({{'d': {apart}, 'c': q.c}}) AS near
  FROM kept p, c{{r}} q GROUP BY p.row, p.vec_id, p.v"""
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS ({assigned.replace('{r}', str(r))})")
        steps.append(f"""s{r} AS (
  SELECT near.c AS c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT near, v, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY near.c, i)""")
        steps.append(f"""m{r} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY c)""")
        steps.append(f"c{r + 1} AS (SELECT q.c, coalesce(m.v, q.v) AS v FROM c{r} q LEFT JOIN m{r} m ON q.c = m.c)")
    steps.append(f"a{rounds} AS ({assigned.replace('{r}', str(rounds))})")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept
  WHERE vec_id IS NOT NULL ORDER BY sha256('1:' || vec_id), v LIMIT 16),
{", ".join(steps)}
SELECT vec_id, CAST(a.near.c AS INTEGER) AS cluster, a.near.d AS distance,
       CAST(sum(a.near.d) OVER (PARTITION BY a.near.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.near.d) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(q.v, 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} q ON a.near.c = q.c
"""


ORACLE: dict[str, str] = {
    "op11_centroids": _centroid_sql(),
    "op3_exact_dedup": r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM ranked
""",
    "op5_decontaminate": r"""
WITH doc_lists AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)),
item_lists AS (
  SELECT item_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM benchmark)),
windows AS (
  SELECT DISTINCT item_id, list_aggregate(ws[k:k + 9], 'string_agg', ' ') AS win,
         least(len(ws), 10) AS size
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS k
        FROM item_lists WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT doc_id, size, k, list_aggregate(ws[k:k + size - 1], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k
        FROM doc_lists, sizes WHERE len(ws) >= size)),
found AS (SELECT doc_id, k, s.size, item_id FROM spots s JOIN windows w ON s.size = w.size AND s.win = w.win),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS word FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
       sha256(coalesce(l.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_lists d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
""",
    "op8_line_dedup": r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
places AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM texts),
keyed AS (
  SELECT doc_id, line, place,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM places),
shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT p.doc_id, p.line, p.place, s.k IS NOT NULL AND p.doc_id <> s.keeper AS lost
  FROM keyed p LEFT JOIN shared s ON p.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
