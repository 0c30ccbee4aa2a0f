"""Repeated passages by a sparse suffix array over minimisers.

Of every `min_words` consecutive words, the run of `GRAM` words with the smallest hash is chosen; the
choice depends on those words alone, so a passage that stands in two documents has the same chosen
positions in both. Only suffixes at chosen positions are kept, about one for 22 words, and of those
only the ones whose first `GRAM` words some other document has at a chosen position, too.

A suffix is seen with its surroundings: `min_words` words from its place on and those before it that
one window with its first words can hold. Equal surroundings are one row of the order, with the
smallest and the largest document that has them, however often they occur: the suffixes behind a row
take its result. From two documents on, all that a row sees is repeated.

Rows are sorted by their first words, by what follows and by what comes before (nearest word first).
Each is compared with those at most `REACH` rows away, and the match is extended word by word to the
right and to the left; from `min_words` words on it is a repeat. A group of up to `REACH` + 1 rows with
equal first words stays in one task and is compared in full. Larger groups are spread over tasks by
what follows. There a partner may be near in no order, so rows that their neighbours do not explain
as far as they see are also searched exactly: the windows of `min_words` words around their first words
are hashed, beside those of rows which share the first or the last part that any such window must
hold, and a window that a second document has is a repeat. Hashes are counted, with a combine on the
map side, not paired, and windows are not written.

Words are runs of a-z, 0-9 and characters beyond ASCII after lower-casing A-Z, so marks and
spacing do not matter. Inputs: NULL and empty texts and texts of fewer words have no repeats. Rows
without a doc_id are not searched. Rows that repeat a doc_id are one document, repeats inside which
do not count. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, by_size, map_slices
from opinlake.llm.decontaminate import cut_words
from opinlake.session import materialize

MIN_WORDS = 50
GRAM = 8
REACH = 16  # rows of the order that a row is compared with on either side
PAST_REACH = 4  # and of the order by what comes before, within a batch of a large group, for longer spans

MINIMISER_SCHEMA = "doc_id long, at int, gram long, look long, ahead int"
ROW_SCHEMA = "gram long, look long, low long, high long, large boolean, after binary, before binary"
MATCH_SCHEMA = (
    "gram long, look long, low long, high long, left int, right int, other long, "
    "large boolean, needy boolean, front long, rear long"
)
WINDOW_SCHEMA = "gram long, look long, low long, high long, needy boolean, start int, window long"
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """A 64-bit hash for each word of each text, never zero."""
    import xxhash

    words, per_text = cut_words(texts)
    names = words.dictionary.to_pylist()
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names)) | np.uint64(1)
    return np.split(hashed[words.indices.to_numpy()], np.cumsum(per_text)[:-1])


def chosen(hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Chosen positions of a document and the hashes of the words from there."""
    if len(hashes) < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(hashes) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(FACTOR) + hashes[k : k + n]
    grams = _mixed(grams)
    windows = sliding_window_view(grams, min_words - GRAM + 1)
    at = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return at, grams[at].view(np.int64)


def looks(hashes: np.ndarray, at: np.ndarray, min_words: int) -> np.ndarray:
    """A hash of the surroundings of each position: differences of running sums, shifted to one place.
    Words beyond the document count as zero, which no word is."""
    past = min_words - GRAM
    made = [np.zeros(0, np.uint64)]
    for k in range(0, len(at), 20_000):
        part = at[k : k + 20_000]
        first, last = part[0] - past, part[-1] + min_words
        words = np.pad(
            hashes[max(first, 0) : min(last, len(hashes))], (max(-first, 0), max(last - len(hashes), 0))
        )
        up = np.cumprod(np.full(len(words), FACTOR, np.uint64))
        down = np.cumprod(np.full(len(words), INVERSE, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * down)])
        start = part - past - first
        made.append(_mixed((sums[start + past + min_words] - sums[start]) * up[start]))
    return np.concatenate(made).view(np.int64)


def _documents(docs: DataFrame) -> DataFrame:
    known = docs.where(F.col("doc_id").isNotNull())
    return as_bytes(known.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")


def minimisers(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, word position, gram, hash of the surroundings and words ahead in sight of every chosen
    position."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        hashed = word_hashes(batch.column(1).to_pylist())
        found = [chosen(h, min_words) for h in hashed]
        seen = [looks(h, at, min_words) for h, (at, _) in zip(hashed, found, strict=True)]
        owner = [np.full(len(at), i, np.int64) for i, (at, _) in zip(ids, found, strict=True)]
        ahead = [np.minimum(len(h) - at, min_words) for h, (at, _) in zip(hashed, found, strict=True)]
        columns = [
            pa.array(np.concatenate(owner)),
            pa.array(np.concatenate([a for a, _ in found]).astype(np.int32)),
            pa.array(np.concatenate([g for _, g in found])),
            pa.array(np.concatenate(seen)),
            pa.array(np.concatenate(ahead).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "at", "gram", "look", "ahead"])

    return map_slices(_documents(docs), work, MINIMISER_SCHEMA)


def shared_suffixes(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The chosen positions whose gram is chosen in at least two documents."""
    found = materialize(minimisers(docs, min_words), "minimisers")
    several = found.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return found.join(several.where("low < high").select("gram"), "gram", "left_semi")


def surroundings(suffixes: DataFrame) -> DataFrame:
    """Each distinct gram and look once: its smallest document with a place there, its largest document,
    and how many there are of the gram."""
    rows = suffixes.groupBy("gram", "look").agg(
        F.min(F.struct("doc_id", "at", "ahead")).alias("first"), F.max("doc_id").alias("high")
    )
    rows = materialize(rows.select("gram", "look", "first.*", "high"), "surroundings")
    # Most grams have one row, which is complete without a join.
    several = rows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(several, "gram", "left").withColumn("n", F.coalesce("n", F.lit(1)))


def rows_in_words(docs: DataFrame, rows: DataFrame, min_words: int) -> DataFrame:
    """The rows with the words after and before their place, read from the text of one document."""
    place = F.struct("at", "gram", "look", "high", (F.col("n") > REACH + 1).alias("large"))
    places = rows.groupBy(F.col("doc_id").alias("own_id")).agg(F.collect_list(place).alias("places"))
    joined = _documents(docs).join(places, F.col("doc_id") == F.col("own_id")).select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text", 1_000_000):
                yield from _in_words(piece, min_words)

    return joined.mapInArrow(run, ROW_SCHEMA)


def _in_words(batch: pa.RecordBatch, min_words: int) -> Iterator[pa.RecordBatch]:
    hashed = word_hashes(batch.column(1).to_pylist())
    edge = np.zeros(min_words, np.uint32)  # beyond the document: equal to nothing
    fixed = lambda a: pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())
    for k, (doc_id, hashes) in enumerate(zip(batch.column(0).to_pylist(), hashed, strict=True)):
        places = batch.column(2)[k].values
        column = lambda name, p=places: p.field(name).to_numpy(zero_copy_only=False)
        at, look = column("at").astype(np.int64), column("look")
        # Of rows that repeat a doc_id, those that are meant.
        mine = np.flatnonzero(at + GRAM <= len(hashes))
        order = mine[np.argsort(at[mine], kind="stable")]
        mine = order[looks(hashes, at[order], min_words) == look[order]]
        small = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        padded = np.concatenate([edge, small, edge])
        for first in range(0, len(mine), 4096):
            part = mine[first : first + 4096]
            middle = (at[part] + min_words)[:, None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column("gram")[part]), pa.array(look[part]), pa.array(np.full(len(part), doc_id, np.int64)),
                    pa.array(column("high")[part]), pa.array(column("large")[part].astype(bool)),
                    fixed(padded[middle + np.arange(min_words)]),
                    fixed(padded[middle - 1 - np.arange(min_words - GRAM)]),
                ],
                ["gram", "look", "low", "high", "large", "after", "before"],
            )


class _Rows:
    """Sorted rows in arrays."""

    NAMES = ("gram", "look", "low", "high", "large", "after", "before")

    def __init__(self, *columns: np.ndarray) -> None:
        self.gram, self.look, self.low, self.high, self.large, self.after, self.before = columns

    @staticmethod
    def of(batch: pa.RecordBatch, min_words: int) -> _Rows:
        wide = lambda name, n: np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(-1, n)
        plain = (batch.column(name).to_numpy(zero_copy_only=False) for name in _Rows.NAMES[:5])
        return _Rows(*plain, wide("after", min_words), wide("before", min_words - GRAM))

    def __len__(self) -> int:
        return len(self.gram)

    def take(self, where) -> _Rows:
        return _Rows(*(getattr(self, n)[where] for n in self.NAMES))

    def then(self, other: _Rows) -> _Rows:
        return _Rows(*(np.concatenate([getattr(self, n), getattr(other, n)]) for n in self.NAMES))


def _hashed(gram: np.ndarray, words: np.ndarray, mark: int) -> np.ndarray:
    """A hash of each row of words, with its gram and a mark."""
    value = gram.view(np.uint64) + np.uint64(mark)
    for k in range(words.shape[1]):
        value = value * np.uint64(FACTOR) + words[:, k]
    return _mixed(value).view(np.int64)


def _halves(rows: _Rows, min_words: int) -> list[pa.Array]:
    """Hashes of the words from each place on and of those up to the end of its gram: a window of
    `min_words` words that holds the gram holds all words of exactly one. NULL beyond the document."""
    ahead = (min_words + GRAM) // 2
    front, rear = rows.after[:, :ahead], rows.before[:, : min_words - ahead + 1]
    return [
        pa.array(_hashed(rows.gram, part, mark), mask=(part[:, -1] == 0)) for mark, part in ((1, front), (2, rear))
    ]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each row."""
    return np.logical_and.accumulate((a == b) & (a != 0), axis=1).sum(axis=1)


def neighbour_matches(rows: _Rows, min_words: int) -> tuple[np.ndarray, ...]:
    """Words to the left and right of each row's place that are repeated, the smallest other document
    of a match, and whether that leaves words in sight that may be repeated as well.

    Every match of a row holds the row's own place, so together they are one stretch from the
    farthest start to the farthest stop.
    """
    n = len(rows)
    sight = (rows.before != 0).sum(axis=1), (rows.after != 0).sum(axis=1)
    several = rows.low < rows.high
    left_most, right_most = np.where(several, sight[0], 0), np.where(several, sight[1], 0)
    partner = np.full(n, np.iinfo(np.int64).max)

    def explained() -> np.ndarray:
        return (left_most == sight[0]) & (right_most == sight[1])

    def compare(own: np.ndarray, other: np.ndarray) -> None:
        fits = rows.gram[own] == rows.gram[other]
        fits &= several[own] | several[other] | (rows.low[own] != rows.low[other])
        full = explained()  # rows that have matched as far as they can see gain nothing more
        fits &= ~(full[own] & full[other])
        own, other = own[fits], other[fits]
        right = _common(rows.after[own], rows.after[other])
        left = _common(rows.before[own], rows.before[other])
        long_ = left + right >= min_words
        own, other, left, right = own[long_], other[long_], left[long_], right[long_]
        for mine, theirs in ((own, other), (other, own)):
            np.maximum.at(left_most, mine, left)
            np.maximum.at(right_most, mine, right)
            apart = np.where(rows.low[theirs] != rows.low[mine], rows.low[theirs], rows.high[theirs])
            np.minimum.at(partner, mine, apart)

    for step in range(1, min(REACH, n - 1) + 1):
        own = np.arange(n - step)
        compare(own, own + step)
    # In large groups also by what comes before.
    large = np.flatnonzero(rows.large & ~explained())
    if len(large):
        keys = np.concatenate(
            [rows.gram[large].astype(">i8").view(np.uint8).reshape(-1, 8),
             np.ascontiguousarray(rows.before[large]).view(np.uint8).reshape(len(large), -1)], axis=1
        )
        by_past = large[np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")]
        for step in range(1, min(PAST_REACH, len(large) - 1) + 1):
            compare(by_past[:-step], by_past[step:])
    return left_most, right_most, partner, rows.large & ~explained()


def matches(rows: DataFrame, min_words: int) -> DataFrame:
    """Each row of the order once, with what its neighbours tell of it."""
    # A small group has one key, so it is in one part; a large one is dealt out by what follows.
    dealt = rows.withColumn("tail", F.when(F.col("large"), F.col("after"))).repartitionByRange("gram", "tail")
    ordered = dealt.drop("tail").sortWithinPartitions("gram", "after", "before")

    def emit(rows: _Rows, which: slice) -> pa.RecordBatch:
        left, right, other, needy = (x[which] for x in neighbour_matches(rows, min_words))
        kept = rows.take(which)
        none = other == np.iinfo(np.int64).max
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array(x) for x in (kept.gram, kept.look, kept.low, kept.high)),
                pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(other, mask=none),
                pa.array(kept.large.astype(bool)), pa.array(needy.astype(bool)), *_halves(kept, min_words),
            ],
            [c.split()[0] for c in MATCH_SCHEMA.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, 0  # rows of the batches before, and how many of them are given out
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Rows.of(batch, min_words)
            rows = rows if held is None else held.then(rows)
            ready = len(rows) - REACH  # rows whose neighbours are all here
            if ready > done:
                yield emit(rows, slice(done, ready))
                first = max(0, ready - REACH)
                rows, done = rows.take(slice(first, None)), ready - first
            held = rows
        if held is not None:
            yield emit(held, slice(done, len(held)))

    return ordered.mapInArrow(run, MATCH_SCHEMA)


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    """Hashes of the windows that hold the gram and a half that another row has."""
    ahead = (min_words + GRAM) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                piece = batch.slice(first, 2048)
                rows = _Rows.of(piece, min_words)
                front, rear, needy = (
                    piece.column(n).to_numpy(zero_copy_only=False).astype(bool)
                    for n in ("by_front", "by_rear", "needy")
                )
                words = np.concatenate([rows.before[:, ::-1], rows.after], axis=1).astype(np.uint64)
                past = rows.before.shape[1]
                for start in range(past + 1):
                    window = words[:, start : start + min_words]
                    wanted = front if min_words - (past - start) >= ahead else rear
                    inside = np.flatnonzero(wanted & (window[:, 0] != 0) & (window[:, -1] != 0))
                    value = _hashed(rows.gram[inside], window[inside], 3 + start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array(x[inside]) for x in (rows.gram, rows.look, rows.low, rows.high, needy)),
                            pa.array(np.full(len(inside), start, np.int32)), pa.array(value),
                        ],
                        [c.split()[0] for c in WINDOW_SCHEMA.split(", ")],
                    )

    return rows.mapInArrow(run, WINDOW_SCHEMA)


def crowded_windows(rows: DataFrame, found: DataFrame, min_words: int) -> DataFrame:
    """For the rows of large groups that their neighbours do not explain: words to the left and right
    of the place in windows of `min_words` words that some other document has, too, and one such
    document."""
    key = ["gram", "look"]
    sides = found.where("large").select(*key, "low", "high", "needy", F.posexplode(F.array("front", "rear")))
    sides = sides.withColumnsRenamed({"pos": "side", "col": "half"}).where("half IS NOT NULL")
    several = sides.groupBy("half").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("needy").alias("needy")
    )
    several = several.where("low < high AND needy").select("half")
    kept = sides.join(several, "half", "left_semi").groupBy(*key).agg(
        F.max(F.col("side") == 0).alias("by_front"), F.max(F.col("side") == 1).alias("by_rear"),
        F.max("needy").alias("needy"),
    )
    meant = materialize(rows.join(kept, key), "crowded_rows")
    shared = _windows(meant, min_words).groupBy("window").agg(
        F.min("low").alias("least"), F.max("high").alias("most"), F.max("needy").alias("asked")
    )
    shared = shared.where("least < most AND asked").select("window", "least", "most")
    hits = _windows(meant.where("needy"), min_words).join(shared, "window")
    past = min_words - GRAM
    # A row in need of windows has one document.
    other = F.when(F.col("low") == F.col("least"), F.col("most")).otherwise(F.col("least"))
    return hits.groupBy(*key).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max(past - F.col("start")).alias("left"),
        F.max(F.col("start") + min_words - past).alias("right"), F.min(other).alias("other"),
    )


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start_word, end_word (exclusive, words from 0) of each maximal stretch made of repeats,
    its length n_words, and other_id, the smallest id among the documents it was matched with. Not all
    holders of a window are matched with each other, so a smaller one may exist."""
    if min_words < 2 * GRAM:
        raise ValueError(f"min_words must be at least {2 * GRAM}")
    suffixes = materialize(shared_suffixes(docs, min_words), "suffixes")
    order = materialize(surroundings(suffixes), "order")
    # The only row of its gram: its suffixes are in two documents and equal as far as they see.
    alone = order.where("n = 1").select(
        "gram", "look", F.col("doc_id").alias("low"), "high",
        F.least("at", F.lit(min_words - GRAM)).alias("left"), F.col("ahead").alias("right"),
        F.lit(None).cast("long").alias("other"),
    )
    rows = materialize(rows_in_words(docs, order.where("n > 1"), min_words), "suffix_rows")
    found = materialize(matches(rows, min_words), "suffix_matches")
    columns = alone.columns
    results = found.where("right > 0").select(*columns).union(alone)
    results = results.union(crowded_windows(rows, found, min_words).select(*columns))
    results = results.groupBy("gram", "look").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("left").alias("left"),
        F.max("right").alias("right"), F.min("other").alias("other"),
    )
    others = F.filter(F.array("low", "high", "other"), lambda x: x != F.col("doc_id"))
    spans = suffixes.join(results, ["gram", "look"]).select(
        "doc_id", (F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("stop"),
        F.array_min(others).alias("other_id"),
    )
    # Per document: overlapping and touching spans become one.
    spans = spans.groupBy("doc_id", "start", "stop").agg(F.min("other_id").alias("other_id"))
    own = Window.partitionBy("doc_id").orderBy("start", "stop")
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.when(F.col("start") <= reach, 0).otherwise(1))
    numbered = opened.withColumn("island", F.sum("opens").over(own))
    merged = numbered.groupBy("doc_id", "island").agg(
        F.min("start").alias("start_word"), F.max("stop").alias("end_word"), F.min("other_id").alias("other_id")
    )
    length = (F.col("end_word") - F.col("start_word")).alias("n_words")
    return merged.select("doc_id", "start_word", "end_word", length, "other_id")
