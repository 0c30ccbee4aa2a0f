"""Near copies by the Jaccard similarity of their word shingles.

Candidates come from the SimHash index of `simhash.py`: texts whose fingerprints are connected over
links of at most two bits share a bucket. At 0.8 about 10 of 64 bits differ, and segments for that many
would select nothing, so pairs the index cannot reach come from MinHash: the smallest values of a text's
shingles under `BANDS` x `BAND_ROWS` hash functions, equal in all rows of some band, share a bucket too.
Two texts of similarity 0.8 miss each other there with a probability of 6e-5, of 0.85 with 4e-7. Every
candidate of either kind is then decided exactly, from the whole sets of shingles, so nothing less
similar is ever linked.

Only distinct texts are indexed, by a 64-bit hash of the text; buckets with the same members count
once. Members of a bucket are dealt by hash into blocks of about `BLOCK` texts and `BLOCK_SHINGLES`
shingles. A block is one small group, compared as a matrix that gives at most one link for each member.

A bucket of one block is decided by that. In a larger one every block also holds the bucket's pivot, its
smallest text, so that rows grow with the members only; blocks of copies meet through it. What the
components of these links leave apart is compared in a second pass: pairs of blocks whose texts are not
of one component already and whose sizes allow the similarity. So no pair of a bucket is left out and no
task holds a whole bucket. Only members of a large bucket that are like neither their pivot nor their
block, texts of one form at less than the similarity, cost more than in proportion.

Inputs: NULL text is empty. Words are parted by ASCII white space, A-Z in lower case. A text with
fewer words than a shingle is a single shingle. Rows that share doc_id and text are one for all
decisions; rows of the same doc_id with other texts, and rows without one, are told apart by text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.llm import simhash
from opinlake.llm.batches import by_size, hand_back, map_slices
from opinlake.llm.components import connected_components
from opinlake.session import materialize

WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 32, 6
BLOCK = 128
BLOCK_SHINGLES = 1 << 20
_AT_ONCE = 4096
_COLUMNS = 8192

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the runs of `words` words, in order."""
    import xxhash

    found = text.lower().split()
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    firsts = np.concatenate([[0], ends[:-1]])[: len(found) - words + 1].tolist()
    lasts = (ends[words - 1 :] - 1).tolist()
    spans = zip(firsts, lasts, strict=True)
    hashed = (xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans)
    return np.unique(np.fromiter(hashed, np.uint64, len(firsts)))


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key for each band: a hash of its smallest values and its number."""
    import xxhash

    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _AT_ONCE):
        part = found[at : at + _AT_ONCE]
        part = part ^ (part >> np.uint64(29))
        for k in range(len(least)):
            least[k] = min(least[k], (part * _FACTORS[k] + _OFFSETS[k]).min())
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64)


def _texts(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, the hash of its text, and the text as bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.cast("binary").alias("text")
    )


def _keys(docs: DataFrame, words: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, made, prints = [], [], []
        for text in batch.column(2).to_pylist():
            found = shingles(text, words)
            sizes.append(len(found))
            made.append(band_keys(found).view(np.int64))
            prints.append(simhash.fingerprint(text, words))
        columns = [
            batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(made, pa.list_(pa.int64())),
            pa.array(np.array(prints, "<u8").view("<i8")),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "size", "keys", "fp"])

    return map_slices(_texts(docs), work, "doc_id long, node long, size long, keys array<long>, fp long")


def _with_simhash(indexed: DataFrame) -> DataFrame:
    """One more key for each text: the component of its fingerprint in the SimHash index. Texts that no
    other is near have a bucket of their own, as with any key."""
    nodes = materialize(indexed.select("fp").distinct(), "near_fingerprints")
    roots = connected_components(simhash.links(nodes)).select(F.col("node").alias("fp"), "root")
    keyed = indexed.join(roots, "fp", "left")
    key = F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp"))
    return keyed.select("node", "size", F.concat("keys", F.array(key)).alias("keys"))


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The shingles of the named texts, each text once."""
    wanted = _texts(docs).join(nodes, "node", "left_semi").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text"):
                made = [shingles(t, words).tobytes() for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(made, pa.binary())], ["node", "found"])
        hand_back()

    return wanted.mapInArrow(run, "node long, found binary").groupBy("node").agg(F.first("found").alias("found"))


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set, the number of the first set that it reaches over pairs of at least that
    Jaccard similarity."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, inverse, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    several = holders > 1
    column = (np.cumsum(several) - 1)[inverse]
    keep = several[inverse]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.int64)
    for first in range(0, int(several.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [first, first + _COLUMNS])
        held = np.zeros((n, _COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - first] = 1
        common += (held @ held.T).astype(np.int64)
    near = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(near, True)
    root = np.arange(n)
    while True:
        lower = np.where(near, root[None, :], n).min(axis=1)
        lower = np.minimum(lower, lower[lower])
        if np.array_equal(lower, root):
            return root
        root = lower


def _parts(n: str, shingles: str) -> Column:
    """How many blocks so many texts with so many shingles are dealt into."""
    return F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def _dealt(parts: str) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(2)), F.col(parts)).cast("int")


def _matches(groups: DataFrame, sets: DataFrame, by: list[str], similarity: float) -> DataFrame:
    """The links within small groups of texts."""

    def compare(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("found").to_pylist()]
        root = linked(sets, similarity)
        hung = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(nodes[root[hung]]), "b": pa.array(nodes[hung])})

    return groups.join(sets, "node").groupBy(*by).applyInArrow(compare, "a long, b long")


def links(docs: DataFrame, indexed: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of text hashes (columns a, b) with the same components as all pairs of candidates of at
    least that similarity. `indexed` has node, size and keys, each node once."""
    entries = indexed.select("node", "size", F.explode("keys").alias("key"))
    buckets = entries.groupBy("key").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("total"),
        F.min("node").alias("pivot"),
        F.expr("bit_xor(xxhash64(node))").alias("x"),
        F.expr("bit_xor(xxhash64(node, 1))").alias("y"),
    )
    buckets = buckets.where("n > 1").groupBy("n", "x", "y").agg(
        F.min("key").alias("key"), F.min("total").alias("total"), F.min("pivot").alias("pivot")
    )
    buckets = buckets.select("key", "pivot", _parts("n", "total").alias("blocks"))
    members = materialize(entries.join(buckets, "key"), "near_buckets")
    sets = materialize(_sets(docs, members.select("node").distinct(), words), "near_sets")
    others = members.where("node != pivot").select("key", _dealt("blocks").alias("block"), "node")
    pivots = members.where("node = pivot").select(
        "key", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "node"
    )
    within = _matches(others.unionByName(pivots), sets, ["key", "block"], similarity)
    within = materialize(within, "near_links")
    wide = members.where("blocks > 1")
    if wide.isEmpty():
        return within
    return within.unionByName(_across(wide, connected_components(within), sets, similarity))


def _across(members: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between texts of a bucket that are not of one component yet.

    Components that fill blocks have blocks of their own (`family`), the others share some; all are
    apart by size, so that texts of the similarity are in the same class or in neighbouring ones.
    """
    keyed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = keyed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    keyed = keyed.join(apart.where("low < high").select("key"), "key")
    keyed = materialize(keyed.select("key", "node", "size", "root"), "near_apart")
    # A little wider than the similarity: rounding must not part two classes.
    level = F.floor(F.log("size") / (-1.001 * math.log(similarity))).cast("int")
    fills = keyed.groupBy("key", "root").agg(F.count("*").alias("n")).where(F.col("n") * 2 > BLOCK)
    fills = fills.select("key", "root", F.lit(True).alias("fills"))
    keyed = keyed.join(fills, ["key", "root"], "left").select(
        "key", "node", "size",
        F.struct(
            F.coalesce("fills", F.lit(False)).alias("own"),
            F.when(F.col("fills"), F.col("root")).otherwise(F.lit(0)).alias("family"),
            level.alias("level"),
        ).alias("kind"),
    )
    kinds = keyed.groupBy("key", "kind").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    kinds = materialize(kinds.select("key", "kind", _parts("n", "total").alias("parts")), "near_kinds")
    dealt = keyed.join(kinds, ["key", "kind"]).select(
        "key", "node", F.struct("kind", _dealt("parts").alias("part")).alias("block")
    )
    blocks = kinds.select("key", "kind", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    one = blocks.select("key", F.struct("kind", "part").alias("i"))
    other = blocks.select("key", F.struct("kind", "part").alias("j"))
    settled = F.expr("i.kind.own AND j.kind.own AND i.kind.family = j.kind.family")
    meet = F.expr("i <= j AND abs(i.kind.level - j.kind.level) <= 1")
    pairs = one.join(other, "key").where(meet & ~settled)
    pairs = pairs.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    groups = dealt.join(pairs, ["key", "block"]).select("key", "i", "j", "node")
    return _matches(groups, sets, ["key", "i", "j"], similarity)


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and text hash (`node`) of all rows that are not the first of their component: that
    with the smallest doc_id, rows without one last."""
    own = materialize(_keys(docs, words), "near_keys")
    indexed = own.groupBy("node").agg(*(F.first(name).alias(name) for name in ("size", "keys", "fp")))
    indexed = materialize(_with_simhash(indexed), "near_index")
    roots = connected_components(links(docs, indexed, words, similarity))
    # A text without a near copy is a component of its own, with all rows that repeat it.
    rooted = own.select("doc_id", "node").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    firsts = rooted.groupBy("root").agg(F.min(order).alias("first"))
    found = rooted.join(firsts, "root")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node"))
    return found.where(~same).select("doc_id", "node").distinct()


def drop_near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with the first row of each component only, all columns as they were."""
    gone = near_copies(docs, words, similarity)
    gone = materialize(gone.select(F.col("doc_id").alias("_gone"), F.col("node").alias("_node")), "near_copies")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = (F.xxhash64(text) == F.col("_node")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_gone"))
    return docs.join(gone, same, "left_anti")
