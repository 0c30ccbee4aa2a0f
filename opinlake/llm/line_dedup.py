"""Line deduplication: hash normalised lines, count their documents, drop, put together again.

A line's key is a 128-bit hash of the line without ASCII white space at its ends and with A-Z in
lower case. Keys are made once a document and meet by hash with a combine on the map side, so a
line that every document has moves once a task. What moves to find the lines to drop are hashes,
never lines; a document's text moves once, to meet the keys that it has to drop.

Inputs: NULL or empty text is one empty line. Lines of fewer than `min_chars` code points always
stay. A key found in `min_docs` documents or more stays only in the one with the smallest doc_id
(all its lines there). Rows that repeat a doc_id are one document with more lines. Rows without
a doc_id are not counted and come back unchanged. Other columns are returned as they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, by_size

ENDS = b" \t\n\v\f\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a lower-cased line, None where it is too short to count."""
    import xxhash

    line = line.strip(ENDS)
    if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode("utf-8")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(line)


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Each key of each document once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text"):
                ids, keys = [], []
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    found = {line_key(x, min_chars) for x in text.lower().split(b"\n")} - {None}
                    ids += [doc_id] * len(found)
                    keys += found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"]
                )

    known = docs.where(F.col("doc_id").isNotNull())
    slim = as_bytes(known.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    return slim.mapInArrow(run, "doc_id long, key binary")


def keys_to_drop(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """doc_id and the keys whose lines it loses."""
    keys = _keys(docs, min_chars)
    found = [F.min("doc_id").alias("first"), F.max("doc_id").alias("last")]
    enough = F.col("first") < F.col("last")
    if min_docs != 2:
        found.append(F.count_distinct("doc_id").alias("docs"))
        enough = F.col("docs") >= min_docs
    shared = keys.groupBy("key").agg(*found).where(enough).select("key", "first")
    lost = keys.join(shared, "key").where(F.col("doc_id") != F.col("first"))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("lost"))


def kept_lines(text: bytes, lost: set[bytes], min_chars: int) -> tuple[int, list[bytes]]:
    """The number of lines of a text and those that stay."""
    lines = text.split(b"\n")
    if not lost:
        return len(lines), lines
    return len(lines), [x for x in lines if line_key(x.lower(), min_chars) not in lost]


def _reassembled(docs: DataFrame, lost: DataFrame, min_chars: int, columns: list[str], digest: bool) -> DataFrame:
    slim = docs.select(
        *(F.col(f"`{c}`").alias(f"_in_{k}") for k, c in enumerate(columns)),
        F.col("doc_id").cast("long").alias("_key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("_text"),
    )
    lost = lost.select(F.col("doc_id").alias("_lost_id"), F.col("lost").alias("_lost"))
    joined = slim.join(lost, F.col("_key") == F.col("_lost_id"), "left").drop("_key", "_lost_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "_text"):
                totals, dropped, made = [], [], []
                for text, gone in zip(
                    piece.column("_text").to_pylist(), piece.column("_lost").to_pylist(), strict=True
                ):
                    total, lines = kept_lines(text, set(gone or ()), min_chars)
                    totals.append(total)
                    dropped.append(total - len(lines))
                    kept = b"\n".join(lines)
                    made.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8"))
                carried = [piece.column(k) for k in range(len(columns))]
                arrays = [pa.array(totals, pa.int64()), pa.array(dropped, pa.int64()), pa.array(made, pa.string())]
                names = [f"_in_{k}" for k in range(len(columns))] + ["_lines", "_dropped", "_made"]
                yield pa.RecordBatch.from_arrays([*carried, *arrays], names)

    schema = ", ".join(
        [f"_in_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(columns)]
        + ["_lines long, _dropped long, _made string"]
    )
    return joined.mapInArrow(run, schema)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """`docs` with the texts that remain; texts that lose nothing are as they were."""
    rest = [c for c in docs.columns if c != "text"]
    made = _reassembled(docs, keys_to_drop(docs, min_chars, min_docs), min_chars, rest, False)
    place = {c: f"_in_{k}" for k, c in enumerate(rest)} | {"text": "_made"}
    return made.select(*(F.col(place[c]).alias(c) for c in docs.columns))


def line_report(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """doc_id, n_lines before dropping, n_dropped, and the digest of what remains."""
    made = _reassembled(docs, keys_to_drop(docs, min_chars, min_docs), min_chars, ["doc_id"], True)
    return made.select(
        F.col("_in_0").cast("long").alias("doc_id"), F.col("_lines").alias("n_lines"),
        F.col("_dropped").alias("n_dropped"), F.col("_made").alias("kept_sha256"),
    )
