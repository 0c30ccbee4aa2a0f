"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates: insults from a lexicon, insults near a second person, capitals, marks,
disguised spellings. The lexicon is a short list of fixed words plus words and word stems that are
learned from labels, so insults of any language count. Of the three folds by the id's checksum,
fold 1 is never seen. The trees (two thirds of the rows) and the calibration (one third) learn from
features that the lexicon of the other fold gives; scoring uses the lexicon of both. All fitting uses at most `MAX_LABELLED` rows; scoring passes over
every whole text once, in the tasks that read it.

Inputs: NULL and empty texts have a score like any other. Without labels of both kinds, the score
is the share of toxic ones among them, 0 if there are none. Rows without a doc_id are scored and
not held out. Rows come back one for one; other columns are ignored by `score_documents`.
"""

from __future__ import annotations

import re

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import SLICE_BYTES, as_bytes, by_size, hand_back, map_slices
from opinlake.llm.labelled import MAX_LABELLED, fold, labelled_texts
from opinlake.llm.text_stats import STATS, TOXIC_STATS, measure
from opinlake.llm.trees import Boosted, boost, isotonic
from opinlake.session import materialize

THRESHOLD = 0.7
LEXICON_SIZE = 2_000  # learned entries at most, the surest first
STEM_LENGTHS = (3, 4, 5, 6)
SURE = 0.85
# Bytes of text measured at a time: measuring holds some fifty bytes for each of them.
MEASURED_BYTES = SLICE_BYTES // 8

# Insults known beforehand: fixed values.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting"
    " clown fool imbecile cretin jerk freak creep vermin filth".split()
)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]

    def __call__(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in STEM_LENGTHS if len(word) >= n)


def _terms(text: bytes) -> set[str]:
    words = {w for w in _WORD.findall(text.decode("utf-8").lower()) if len(w) > 2}
    return words | {f"{w[:n]}*" for w in words for n in STEM_LENGTHS if len(w) >= n}


def count_terms(sample: DataFrame) -> DataFrame:
    """fold, term and the numbers of distinct toxic and clean texts of the fold that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text"):
                counts: dict[int, tuple[Counter, Counter]] = {}
                for text, number, label in zip(*(piece.column(k).to_pylist() for k in range(3)), strict=True):
                    counts.setdefault(number, (Counter(), Counter()))[label].update(_terms(text))
                for number, (clean, toxic) in counts.items():
                    terms = list(toxic | clean)
                    columns = [pa.array([c[t] for t in terms], pa.int64()) for c in (toxic, clean)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(terms), pa.int32()), pa.array(terms, pa.string()), *columns],
                        ["fold", "term", "toxic", "clean"],
                    )
        hand_back()

    distinct = sample.groupBy("text").agg(F.min("fold").alias("fold"), F.max("label").alias("label"))
    counted = distinct.mapInArrow(run, "fold int, term string, toxic long, clean long")
    totals = counted.groupBy("fold", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return materialize(totals, "term_counts")


def learn_lexicon(counted: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """Words and stems whose documents are surely toxic."""
    totals = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sure = (F.col("toxic") + 1) / (F.col("toxic") + F.col("clean") + 2)
    best = totals.where(sure >= SURE).orderBy(F.desc("toxic"), "clean", "term").limit(size)
    found = [row["term"] for row in best.collect()]
    stems = frozenset(t[:-1] for t in found if t.endswith("*"))
    return Lexicon(INSULTS | frozenset(t for t in found if not t.endswith("*")), stems)


def _measured(texts: list[bytes], lexicon: Lexicon) -> np.ndarray:
    """`measure`, whose rows depend on their own text only, over a bounded part of the texts at a time."""
    ends, cuts = np.cumsum([len(t) for t in texts]), [0]
    while cuts[-1] < len(texts):
        before = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, before + MEASURED_BYTES, "right"))))
    parts = [measure(texts[a:b], lexicon) for a, b in zip(cuts, cuts[1:], strict=False)]
    return np.concatenate(parts) if parts else measure([], lexicon)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted
    points: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[bytes]) -> np.ndarray:
        margin = self.trees.margin(_measured(texts, self.lexicon))
        return np.clip(np.interp(margin, *self.points), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> ToxicityModel:
    sample = labelled_texts(docs, labels, "toxic", limit)
    counted = count_terms(sample)
    # The features that the trees learn from must not know their own rows' words.
    others = {0: learn_lexicon(counted.where("fold = 2")), 2: learn_lexicon(counted.where("fold = 0"))}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, folds = batch.column("text").to_pylist(), batch.column("fold").to_pylist()
        stats = np.zeros((len(texts), len(STATS) + len(TOXIC_STATS)))
        for number, lexicon in others.items():
            own = [k for k, f in enumerate(folds) if f == number]
            stats[own] = _measured([texts[k] for k in own], lexicon)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(stats) + 1) * stats.shape[1], pa.int32()), pa.array(stats.ravel())
        )
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), lists], ["doc_id", "label", "stats"]
        )

    # At most `limit` rows of some numbers each come to the driver.
    rows = map_slices(sample, work, "doc_id long, label int, stats array<double>")
    rows = rows.orderBy("doc_id").collect()
    x = np.array([r["stats"] for r in rows]).reshape(len(rows), len(STATS) + len(TOXIC_STATS))
    y = np.array([r["label"] for r in rows], float)
    lexicon = learn_lexicon(counted)
    third = np.arange(len(rows)) % 3 == 0
    if len({*y[third]}) < 2 or len({*y[~third]}) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(lexicon, Boosted(0.0, 0.0, []), (np.zeros(1), np.array([share])))
    trees = boost(x[~third], y[~third])
    return ToxicityModel(lexicon, trees, isotonic(trees.margin(x[third]), y[third]))


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1: toxic), one row for each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.score(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    slim = as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    scored = map_slices(slim, work, "doc_id long, score double")
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows whose texts score at least `threshold`, all columns as they were.

    Rows are scored and let through in one pass, each by its own text, whatever its id; nothing is
    shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
        return batch.filter(pa.array(shared.value.score(texts) < threshold))

    return map_slices(docs, work, docs.schema, limit=SLICE_BYTES // 2)
