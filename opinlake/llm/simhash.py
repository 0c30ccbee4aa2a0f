"""Near-duplicate detection by SimHash and deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits: of two fingerprints that differ in at
most two bits, one segment differs by at most one. Each segment is indexed under its 32
one-wildcard variants, so such a pair meets in a bucket, and an equality join plus a check of all
64 bits gives the links. A pair that meets in many buckets is taken from one of them only.

Only distinct fingerprints are indexed; copies share theirs and never multiply. A bucket may
still be large, when many near copies agree in a segment: buckets of more than `BUCKET_LIMIT`
fingerprints are not joined, and segment values of more than `CROWD` fingerprints, together with
the values next to them, not even indexed, so no task sees a bucket of more than twice that. Their
members are linked exactly by another way without a group that grows: each is entered under itself and its 64 one-bit neighbours. Two differ by at most two bits
exactly when they share such an entry, an entry has at most 65 members, and hanging these on the
smallest gives the same components as all their links.

Inputs: NULL text is empty. A text without words has fingerprint zero, linked like any other; one
with fewer words than a shingle is a single shingle. Rows without a doc_id take part, but no
component is named after them (a component of such rows only has a NULL name). Rows that repeat a
doc_id are returned one for one. Other columns are ignored by `near_duplicates`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, map_slices
from opinlake.llm.components import connected_components
from opinlake.session import materialize

BUCKET_LIMIT = 32
CROWD = 100_000
MAX_BITS = 2  # what two segments with one wildcard each can find
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the shingles of a text, repeats included."""
    import xxhash

    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    firsts = starts[:n].tolist()
    lasts = (ends[min(words, len(found)) - 1 :][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _HASHES_AT_ONCE):
        stop = at + _HASHES_AT_ONCE
        spans = zip(firsts[at:stop], lasts[at:stop], strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and its fingerprint as a signed long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
        signed = np.array(made, "<u8").view("<i8")
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    slim = as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    return map_slices(slim, work, "doc_id long, fp long")


def segments(nodes: DataFrame) -> DataFrame:
    """fp, the number of the segment and its 32 bits."""
    cut = nodes.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("segment"))
    value = F.expr("shiftrightunsigned(fp, 32 * segment) & 4294967295L")
    return cut.select("fp", "segment", value.alias("value"))


def variants(cut: DataFrame) -> DataFrame:
    """fp and the 32 keys a segment is indexed under: its bits with one of them cleared, and above
    them the numbers of the segment and of that bit. Keys are exact, not hashed."""
    keyed = cut.select("*", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
    key = "(value & ~shiftleft(1L, bit)) | shiftleft(CAST(32 * segment + bit AS BIGINT), 32)"
    return keyed.select("fp", F.expr(key).alias("key"))


def joined_links(members: DataFrame) -> DataFrame:
    """Verified pairs of fingerprints that share a key, each pair once."""
    a = members.select(F.col("fp").alias("a"), "key")
    b = members.select(F.col("fp").alias("b"), F.col("key").alias("other"))
    change = F.col("a").bitwiseXOR(F.col("b"))
    low = change.bitwiseAND(0xFFFFFFFF)
    high = F.shiftrightunsigned(change, 32)
    variant = F.shiftright("key", 32)
    own = F.when(variant < 32, low).otherwise(high)
    wildcard = F.expr("shiftleft(1L, CAST(shiftright(key, 32) % 32 AS INT))")
    # Of the buckets in which a pair meets: the one of the differing bit, or of bit 0 if the
    # segments are equal; and the upper segment only where the lower one differs too much.
    once = ((own == wildcard) | ((own == 0) & (variant % 32 == 0))) & (
        (variant < 32) | (F.bit_count(low) > 1)
    )
    near = F.bit_count(change) <= MAX_BITS
    same = F.col("key") == F.col("other")
    return a.join(b, same & (F.col("a") < F.col("b")) & near & once).select("a", "b")


def neighbour_links(nodes: DataFrame) -> DataFrame:
    """Links with the same components as all pairs of at most two differing bits, at most 65 for
    each fingerprint."""
    entries = nodes.select(
        "fp",
        F.explode(
            F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
        ).alias("entry"),
    )
    groups = entries.groupBy("entry").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    hung = groups.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return hung.where("a != b").distinct()


def links(nodes: DataFrame, bucket_limit: int = BUCKET_LIMIT, crowd: int = CROWD) -> DataFrame:
    """Links between distinct fingerprints (column `fp`) of at most two differing bits: all pairs
    from buckets up to the limit, and enough of them for the same components from larger ones."""
    cut = segments(nodes)
    crowded = materialize(
        cut.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > crowd).drop("n"),
        "crowded_segments",
    )
    beside = crowded.select(
        "segment",
        F.explode(
            F.expr("concat(array(value), transform(sequence(0, 31), i -> value ^ shiftleft(1L, i)))")
        ).alias("value"),
    )
    value = ["segment", "value"]
    apart = cut.join(beside.distinct(), value, "left_semi").select("fp")
    # One shuffle for the index: sizes by a window, and most entries, alone in their bucket, end.
    indexed = variants(cut.join(crowded, value, "left_anti"))
    sized = indexed.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    shared = materialize(sized.where("n > 1"), "shared_buckets")
    large = shared.where(F.col("n") > bucket_limit).select("fp").union(apart).distinct()
    return joined_links(shared.where(F.col("n") <= bucket_limit)).union(neighbour_links(large))


def near_duplicates(docs: DataFrame, words: int = 3, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that is
    reachable over links, one row for each row of `docs`."""
    own = materialize(fingerprints(docs, words), "fingerprints")
    nodes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    roots = connected_components(links(nodes.select("fp"), bucket_limit))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root").select(F.col("fp").alias("named"), "component_id")
    return own.join(named, F.col("fp") == F.col("named")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """`docs` with the smallest doc_id of each component only, all columns as they were.

    Rows without a doc_id cannot be told apart by it, so they all stay.
    """
    found = near_duplicates(docs, words)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = materialize(gone.select(F.col("doc_id").alias("_gone")).distinct(), "near_copies")
    same = F.col("doc_id").cast("long") == F.col("_gone")
    return docs.join(gone, same, "left_anti")
