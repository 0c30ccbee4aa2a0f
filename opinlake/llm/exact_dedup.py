"""Exact deduplication by recipes of content-defined chunks, in DataFrame functions alone.

A text, without its ASCII white space, is cut where its own characters say so, so equal stretches
of different texts make equal chunks. Distinct chunks are found by grouping on their full text
(combined on the map side, so a chunk that a third of all documents share moves once a task) and
get an identifier: the hash, verified to belong to one chunk text only, with an ordinal where it
does not. A document is then the ordered list of its identifiers, its recipe. Equal recipes mean
equal texts; recipes, some numbers for a long document, are what is grouped and joined.

Inputs: NULL text is empty; empty texts are equal to each other. Of equal texts the one with the
most code points, then the smallest doc_id stays; a NULL doc_id loses to any other. Rows that
repeat a doc_id with equal text of equal length share its decision, and `drop_repeats` returns
them once. Other columns are ignored by `find_repeats` and returned by `drop_repeats`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinlake.session import materialize

CHUNK_MIN, CHUNK_MAX = 256, 4096
# A cut lies behind five characters of this class. Beyond Latin it takes a quarter of each
# stretch of 4096 code points; text without any cut is cut at the greatest length.
CUT_CLASS = "[aeinrst0-3\\u00e0-\\u00ef" + "".join(
    f"\\u{page:x}000-\\u{page:x}3ff" for page in range(1, 13)
) + "\\u0430-\\u043f]"
CHUNKS = (
    f"(?s).{{{CHUNK_MIN},{CHUNK_MAX - 1}}}?(?<={CUT_CLASS}{{5}})|(?s).{{1,{CHUNK_MAX}}}"
)
BLANKS = "[\\x20\\x09-\\x0D]+"

Hash = Callable[[Column], Column]


def squeezed(text: Column) -> Column:
    """The text without ASCII white space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def _chunked(docs: DataFrame) -> DataFrame:
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("doc_id", F.char_length("text").alias("n_chars"), squeezed(F.col("text")).alias("bare"))
    return slim.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("bare").cast("binary"), 256).alias("text_sha256"),
        F.regexp_extract_all("bare", F.lit(CHUNKS), F.lit(0)).alias("chunks"),
    )


def shared_hashes(chunked: DataFrame, hash_of: Hash) -> DataFrame:
    """Chunk texts whose hash some other chunk text has too, numbered within the hash."""
    chunks = chunked.select(F.explode("chunks").alias("chunk"))
    distinct = chunks.groupBy(hash_of(F.col("chunk")).alias("hash"), "chunk").agg(F.count("*").alias("n"))
    # Most hashes have one text: first find the others by number alone.
    several = distinct.groupBy("hash").agg(F.count("*").alias("texts"))
    shared = materialize(several.where("texts > 1").select("hash"), "shared_hashes")
    if shared.isEmpty():
        return shared.select("hash", F.lit("").alias("chunk"), F.lit(0).alias("ordinal"))
    own = Window.partitionBy("hash").orderBy("chunk")
    return materialize(
        distinct.join(shared, "hash", "left_semi").select(
            "hash", "chunk", F.row_number().over(own).alias("ordinal")
        ),
        "chunk_ordinals",
    )


def recipes(docs: DataFrame, hash_of: Hash = F.xxhash64) -> DataFrame:
    """doc_id, n_chars, text_sha256 and the recipe: the identifiers of the chunks in order."""
    chunked = _chunked(docs)
    ordinals = shared_hashes(chunked, hash_of)
    if ordinals.isEmpty():
        hashes = F.transform("chunks", lambda c: F.struct(hash_of(c).alias("hash"), F.lit(0).alias("ordinal")))
        return chunked.select("doc_id", "n_chars", "text_sha256", hashes.alias("recipe"))
    keys = ["doc_id", "n_chars", "text_sha256"]
    places = chunked.select(*keys, F.posexplode_outer("chunks").alias("at", "chunk"))
    places = places.withColumn("hash", hash_of(F.col("chunk"))).join(ordinals, ["hash", "chunk"], "left")
    listed = F.array_sort(
        F.collect_set(
            F.when(
                F.col("chunk").isNotNull(),
                F.struct("at", "hash", F.coalesce("ordinal", F.lit(0)).alias("ordinal")),
            )
        )
    )
    built = places.groupBy(*keys).agg(F.transform(listed, lambda x: F.struct(x["hash"], x["ordinal"])).alias("r"))
    # One row for each row of `docs`, also for repeated ones.
    given = chunked.select(*keys)
    same = F.lit(True)
    for key in keys:
        same = same & given[key].eqNullSafe(built[key])
    return given.join(built, same).select(*(given[k] for k in keys), built["r"].alias("recipe"))


def _keepers(listed: DataFrame) -> DataFrame:
    # The bitwise complement turns the order of ids around and cannot overflow.
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("turned")))
    return (
        listed.groupBy("recipe")
        .agg(F.count("*").alias("group_size"), best.alias("best"), F.min("text_sha256").alias("sha"))
        .select(
            F.col("recipe").alias("kept_recipe"),
            "group_size",
            F.col("best.n_chars").alias("keep_chars"),
            F.bitwise_not("best.turned").alias("keep_id"),
            "sha",
        )
    )


def find_repeats(docs: DataFrame, hash_of: Hash = F.xxhash64) -> DataFrame:
    """One row for each row of `docs`: the document that stays for it and whether it is this one."""
    listed = materialize(recipes(docs, hash_of), "recipes")
    groups = _keepers(listed)
    # A group may hold a third of all rows: its recipe repeats on one side only, which adaptive
    # execution splits.
    joined = listed.join(groups, F.col("recipe") == F.col("kept_recipe"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return joined.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"),
        "text_sha256",
    )


def drop_repeats(docs: DataFrame, hash_of: Hash = F.xxhash64) -> DataFrame:
    """`docs` without the documents that repeat another one, all columns as they were."""
    listed = materialize(recipes(docs, hash_of), "recipes")
    groups = _keepers(listed).select("keep_id", "keep_chars", "sha")
    names = {c: f"_in_{k}" for k, c in enumerate(docs.columns)}
    marked = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in names.items()),
        F.col("doc_id").cast("long").alias("_key"),
        F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).alias("_chars"),
        F.sha2(squeezed(F.col("text")).cast("binary"), 256).alias("_sha"),
    )
    # The digest only leads from a keeper's recipe to its row; the id and the length are part
    # of the key, so that many copies do not meet in one task.
    own = (
        (F.col("_sha") == F.col("sha"))
        & (F.col("_chars") == F.col("keep_chars"))
        & F.col("_key").eqNullSafe(F.col("keep_id"))
    )
    kept = marked.join(groups, own).dropDuplicates(["_sha", "_chars", "_key"])
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))
