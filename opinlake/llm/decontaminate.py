"""Benchmark decontamination with a distributed positional inverted index of the training texts.

Build: every task turns its documents into segments, one row each of a Parquet table in the
shared folder. A segment has its documents' ids and lengths, the distinct terms, and for each term
its postings: ascending positions in the segment, where documents follow each other with room
between them. Nothing is shuffled, a segment is bounded by the text it was made of (a longer
text is a segment of its own), and the index can be searched again for other benchmarks.

Search: test windows go to the segments. In a segment, windows with a term it lacks fall away at
once. For the others the posting lists, moved back by the term's place in the window, are
intersected from the locally rarest term on, so the first list is short and most windows end after
one or two steps. What is left are exact phrase matches, or with `slack` proximity matches: every
term within that many words of where the phrase would have it. Terms are compared as text, not by
hash, so matches need no further check.

The test set is sent to tasks in slices of at most `SLICE_WORDS` words of windows, measured on the
way: a benchmark of any size takes more passes over the index, not more memory.

Inputs: NULL text has no words; texts and items without words match nothing. An item with fewer
words than a window is one window. Rows without a doc_id are searched like others; rows that
repeat one are returned one for one. Items without an id take part in hits but are not listed;
rows that repeat an item_id count as one item. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, hand_back, map_slices
from opinlake.session import materialize, scratch_path, with_settings

WINDOW = 10
SLICE_WORDS = 2_000_000  # words of test windows in one pass, some 30 MB in a task
GAP = 64  # positions between documents, at least a window and its slack

SEGMENT_SCHEMA = (
    "doc_ids array<long>, text_hashes array<long>, doc_words array<int>, terms array<binary>,"
    " counts binary, positions binary"
)

# A segment is a row group of its own, and so a page. The writer asks for sizes only every 100 rows, by which
# it would hold hundreds of MB, and Spark's reader holds all rows of a group, up to 4,096, at once.
_SEGMENTS = {"parquet.block.row.count.limit": "1"}
# And a task gets one at a time; by default as many as make 64 MB, which are held outside the heap and again
# in Python.
_ONE_BY_ONE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}


def _word_bytes() -> np.ndarray:
    kinds = np.zeros(256, bool)  # 0-9, a-z and every byte of a character beyond ASCII
    kinds[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return kinds


WORD_BYTE = _word_bytes()


def cut_words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of many texts, lower-cased and dictionary-encoded, and how many each text has."""
    held = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    inside = WORD_BYTE[held]
    turns = np.flatnonzero(np.diff(inside, prepend=False))
    starts, stops = turns[::2], turns[1::2]
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held[inside])]
    ).dictionary_encode()
    borders = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    per_text = np.diff(np.searchsorted(starts, borders), prepend=0)
    return words, per_text


def build_index(docs: DataFrame) -> DataFrame:
    """The segments of the positional index, as a written table."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        texts = batch.column(1).to_pylist()
        words, per_text = cut_words(texts)
        # The hash that Spark's xxhash64 makes of the text.
        hashes = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
        text_of = np.repeat(np.arange(len(per_text)), per_text)
        places = np.arange(len(words)) + GAP * text_of
        codes = words.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        counts = np.bincount(codes, minlength=len(words.dictionary))
        one = lambda values, kind: pa.ListArray.from_arrays([0, len(values)], pa.array(values, kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays([0, batch.num_rows], batch.column(0)),
                one(hashes, pa.int64()),
                one(per_text, pa.int32()),
                pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary),
                pa.array([counts.astype("<i4").tobytes()], pa.binary()),
                pa.array([places[order].astype("<i4").tobytes()], pa.binary()),
            ],
            ["doc_ids", "text_hashes", "doc_words", "terms", "counts", "positions"],
        )

    slim = as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "positional_index")
    map_slices(slim, work, SEGMENT_SCHEMA).write.options(**_SEGMENTS).parquet(path)
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


@dataclass
class Windows:
    """Test windows of one slice, grouped by their number of words."""

    terms: list[bytes]
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]  # rows of term numbers; window numbers
    items: list[list[int]]  # the items of each window


def cut_windows(items: list[tuple[int | None, bytes]], window: int = WINDOW) -> Windows:
    """Distinct windows of some items."""
    words, per_item = cut_words([text for _, text in items])
    codes, at = words.indices.to_numpy(), 0
    found: dict[tuple[int, ...], set[int]] = {}
    for (item_id, _), n in zip(items, per_item.tolist(), strict=True):
        own = codes[at : at + n].tolist()
        at += n
        for k in range(max(1, n - window + 1) if n else 0):
            holders = found.setdefault(tuple(own[k : k + window]), set())
            if item_id is not None:
                holders.add(item_id)
    by_length: dict[int, tuple[list, list]] = {}
    for number, codes_ in enumerate(found):
        rows, numbers = by_length.setdefault(len(codes_), ([], []))
        rows.append(codes_)
        numbers.append(number)
    return Windows(
        words.dictionary.to_pylist(),
        {n: (np.array(rows, np.int32), np.array(nums)) for n, (rows, nums) in by_length.items()},
        [sorted(x) for x in found.values()],
    )


def _shifted(positions: np.ndarray, back: int, among: np.ndarray, slack: int) -> np.ndarray:
    """Which of the ascending starts `among` have a position `back` words on, give or take `slack`."""
    at = np.searchsorted(positions, among + back - slack)
    inside = at < len(positions)
    return inside & (positions[np.minimum(at, len(positions) - 1)] <= among + back + slack)


def match_segment(
    terms: pa.Array, counts: np.ndarray, positions: np.ndarray, tests: Windows, slack: int = 0
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Window number, its number of words, and where in the segment it starts."""
    ends = np.cumsum(counts)
    starts = ends - counts
    own = pc.index_in(pa.array(tests.terms, pa.binary()), value_set=terms).fill_null(-1).to_numpy()
    for length, (rows, numbers) in tests.by_length.items():
        local = own[rows]
        for k in np.flatnonzero((local >= 0).all(axis=1)):
            lists = local[k]
            order = np.argsort(counts[lists], kind="stable")
            rarest = order[0]
            found = positions[starts[lists[rarest]] : ends[lists[rarest]]].astype(np.int64) - rarest
            for step in order[1:]:
                term = lists[step]
                found = found[_shifted(positions[starts[term] : ends[term]], step, found, slack)]
                if not len(found):
                    break
            if len(found):
                yield int(numbers[k]), length, found


def search(index: DataFrame, tests: Windows, slack: int = 0) -> DataFrame:
    """One row for each document of the index: doc_id, text_hash, n_words, the merged spans of words inside
    any match (`starts`, `stops`; for proximity the span where the phrase would be), and the items
    that match. A written table, as segments are handed to tasks by a setting of the session."""
    shared = index.sparkSession.sparkContext.broadcast(tests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield _search_segment(batch.slice(k, 1), shared.value, slack)
        hand_back()

    found = index.mapInArrow(
        run,
        "doc_id long, text_hash long, n_words long, starts array<int>, stops array<int>,"
        " items array<long>",
    )
    with with_settings(index.sparkSession, _ONE_BY_ONE):
        return materialize(found, "slice_matches")


def _search_segment(row: pa.RecordBatch, tests: Windows, slack: int) -> pa.RecordBatch:
    doc_ids, hashes = row.column(0).flatten(), row.column(1).flatten()
    doc_words, terms = row.column(2).flatten().to_numpy(), row.column(3).flatten()
    counts = np.frombuffer(row.column(4)[0].as_py(), "<i4").astype(np.int64)
    positions = np.frombuffer(row.column(5)[0].as_py(), "<i4")
    firsts = np.cumsum(doc_words + GAP) - doc_words - GAP
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[int]] = {}
    for number, length, found in match_segment(terms, counts, positions, tests, slack):
        docs = np.searchsorted(firsts, np.maximum(found, 0), "right") - 1
        for doc, start in zip(docs.tolist(), (found - firsts[docs]).tolist(), strict=True):
            span = max(0, start), min(int(doc_words[doc]), start + length)
            if span[0] < span[1]:
                spans.setdefault(doc, []).append(span)
                items.setdefault(doc, set()).update(tests.items[number])
    merged = [merge_spans(spans.get(d, [])) for d in range(len(doc_ids))]
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            hashes,
            pa.array(doc_words, pa.int64()),
            pa.array([[a for a, _ in m] for m in merged], pa.list_(pa.int32())),
            pa.array([[b for _, b in m] for m in merged], pa.list_(pa.int32())),
            pa.array([sorted(items.get(d, ())) for d in range(len(doc_ids))], pa.list_(pa.int64())),
        ],
        ["doc_id", "text_hash", "n_words", "starts", "stops", "items"],
    )


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(stop, merged[-1][1])
        else:
            merged.append((start, stop))
    return merged


def test_slices(items: DataFrame, window: int = WINDOW, slice_words: int = SLICE_WORDS) -> Iterator[Windows]:
    """The windows of the test items, in slices of bounded size.

    An item of n words makes about n windows of `window` words. Items come to the driver one
    partition's slice at a time and leave it before the next.
    """
    slim = as_bytes(items.withColumn("item_id", F.col("item_id").cast("long")), "item_id")
    held: list[tuple[int | None, bytes]] = []
    size = 0
    for row in slim.where(F.length("text") > 0).toLocalIterator():
        text = bytes(row["text"])
        words = text.count(b" ") + text.count(b"\n") + 1
        if held and size + words * window > slice_words:
            yield cut_windows(held, window)
            held, size = [], 0
        held.append((row["item_id"], text))
        size += words * window
    if held:
        yield cut_windows(held, window)


def find_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0, slice_words: int = SLICE_WORDS
) -> DataFrame:
    """One row for each document: doc_id, text_hash, n_words, merged spans (`starts`, `stops`) and
    items."""
    if window + slack >= GAP:
        raise ValueError(f"window and slack together must be below {GAP}")
    index = build_index(docs)
    found = [search(index, tests, slack) for tests in test_slices(items, window, slice_words)]
    if not found:
        return search(index, Windows([], {}, []))
    if len(found) == 1:
        return found[0]
    return _combine(found)


def _combine(found: list[DataFrame]) -> DataFrame:
    """Results of several slices, brought together by id and text: what is combined is bounded by
    the document's own length, and rows of equal id and text are counted and given back."""
    whole = None
    for part in found:
        whole = part if whole is None else whole.union(part)
    count = F.lit(len(found))
    merged = whole.groupBy("doc_id", "text_hash", "n_words").agg(
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("stops")).alias("stops"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.round(F.count("*") / count).cast("int").alias("copies"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            spans = [merge_spans(list(zip(a, b, strict=True))) for a, b in pairs]
            columns = list(batch.columns)
            columns[3] = pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int32()))
            columns[4] = pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    united = merged.mapInArrow(run, merged.schema)
    repeated = united.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.drop("copies", "copy")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence of a window), n_items, the digest of the
    sorted item ids, and whether there is any hit."""
    found = find_matches(docs, items, window)
    spans = F.zip_with("stops", "starts", lambda b, a: (b - a).cast("long"))
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, n: total + n)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the documents that have a test window, all columns as they were.

    Rows are told apart by id and text, so rows without an id and rows that share one are each decided
    by their own text.
    """
    found = find_matches(docs, items, window).where(F.size("starts") > 0)
    gone = found.select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_text")).distinct()
    gone = materialize(gone, "contaminated")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = (F.xxhash64(text) == F.col("_text")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_gone"))
    return docs.join(gone, same, "left_anti")
