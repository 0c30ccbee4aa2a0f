"""Spelling variants of words: all words that differ by one character, found over trie nodes.

The distinct words are numbered as two tries, one of the words and one of the reversed words, so
every beginning and every ending of a word is an integer. A word of k characters has k pairs with one
character skipped (the node before it, the node after it) and k + 1 pairs with nothing skipped. Two
words differ by one replaced character exactly when they share a pair with a skip at the same place,
and by one inserted character exactly when a skip pair of the longer is a whole pair of the shorter.
Pairs of integers are grouped by equality; no strings are compared and nothing is verified after.

A skip pair fixes all of a word but one character, so a group has at most one word for each letter of
the alphabet (90 here) and one shorter word. Each of a group's words needs the group's number of words
and its most frequent two, so no pairs of words are made. Of equal letters in a row only the first is
taken as inserted, hence no two words meet twice.

Nodes are numbered while sorted words stream by: a word adds a node for each character after what it
shares with the word before. Every part of the sorted order numbers its own nodes; the driver gets the
first and last word of each part, and shifts the parts' numbers and hands a part the nodes that its
first word shares with the last one of the part before. That is one row a part, whatever the corpus.
Numbers of whole words grow in code-point order, which settles ties.

Inputs: NULL and empty texts have no words. Words of rows without a doc_id are taken as they are, as
there is no hash to change them by. Rows that repeat a doc_id or a text are all counted. No words, no
rows. Very long texts are worked on one at a time, very long words as any other. Other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, by_size
from opinlake.session import delete_path, materialize

MIN_LENGTH = 6
MIN_COUNT = 5
TIMES = 5  # how often more a form occurs than its variant, at least
EVERY = 199  # one run of letters in so many loses a character; 0 for none

# Distinct words that a task holds before it hands its counts on.
_HELD = 200_000
_PAIRS_AT_ONCE = 2_000


def words_of(text: bytes, doc_id: int | None, min_length: int = MIN_LENGTH, every: int = EVERY) -> Counter:
    """Counts of the words of a text: runs of letters with A-Z in lower case, of which one in `every`
    has lost a character, picked by a hash of doc_id and run."""
    # A greedy run of that many letters or more is a maximal one.
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)
    found = Counter(pattern.findall(text.lower().decode("utf-8", "replace")))
    if doc_id is None or not every:
        return found
    start, words = zlib.crc32(b"%d:" % doc_id), Counter()
    for run, n in found.items():
        hashed = zlib.crc32(run.encode(), start)
        if hashed % every == 0:
            at = hashed % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_length:
                continue
        words[run] += n
    return words


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EVERY
) -> DataFrame:
    """word and n, its occurrences in all texts, of the words with at least `min_count`."""

    def packed(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for piece in by_size(batch, "text"):
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    total.update(words_of(text, doc_id, min_length, every))
                    if len(total) > _HELD:
                        yield packed(total)
                        total = Counter()
        yield packed(total)

    slim = as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    counted = slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _shared(a: str, b: str) -> int:
    """Length of the common start."""
    at, most = 0, min(len(a), len(b))
    while at < most and a[at] == b[at]:
        at += 1
    return at


def trie_paths(words: DataFrame, key: Column) -> DataFrame:
    """The columns of `words` (one row for each distinct key) and `path`: the numbers, from 1 on, of the
    trie nodes from the key's first character to its last. Node 0 is the root."""
    names = words.columns
    ordered = words.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before, path, made = "", [], 0
        for batch in batches:
            offsets, values = [0], []
            for own in batch.column("key").to_pylist():
                kept = _shared(before, own)
                path = path[:kept] + list(range(made, made + len(own) - kept))
                made += len(own) - kept
                values += path
                offsets.append(len(values))
                before = own
            paths = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, paths, parts], [*batch.schema.names, "path", "part"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields)
    numbered = materialize(ordered.mapInArrow(run, f"{schema}, path array<long>, part int"), "trie")
    # One row for each part of the sorted order.
    borders = numbered.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("path", "key").alias("path")
    )
    shifts, free, before, above = [], 1, "", []
    for row in sorted(borders.collect(), key=lambda r: r["part"]):
        inherited = above[: _shared(before, row["first"])]
        shift = free - len(inherited)
        shifts.append((row["part"], inherited, shift))
        above = [inherited[x] if x < len(inherited) else shift + x for x in row["path"]]
        before, free = row["last"], shift + row["path"][-1] + 1
    moves = words.sparkSession.createDataFrame(shifts, "own int, inherited array<long>, shift long")
    joined = numbered.join(F.broadcast(moves), F.col("part") == F.col("own"))
    path = F.transform("path", lambda x: F.coalesce(F.get("inherited", x.cast("int")), F.col("shift") + x))
    return joined.select(*names, path.alias("path"))


def node_pairs(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """Every pair of nodes of every word: p before and s after a place. `kind` is 0 where nothing is
    skipped, 1 where one character is, 2 where that character stands before it, too. `word_id` is the
    node of the whole word, n its count."""
    paths = forward.join(backward.withColumnRenamed("path", "back"), F.col("word") == F.col("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _PAIRS_AT_ONCE):
                yield _pairs(batch.slice(first, _PAIRS_AT_ONCE))

    slim = paths.select("word", "n", "path", "back")
    return slim.mapInArrow(run, "p long, s long, word_id long, n long, kind byte")


def _pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
    befores, afters, kinds, sizes, ids = [], [], [], [], []
    for word, path, back in zip(*(batch.column(c).to_pylist() for c in ("word", "path", "back")), strict=True):
        k = len(word)
        before = np.array([0, *path])
        after = np.array([0, *back])[::-1]
        befores += [before[:k], before]
        afters += [after[1:], after]
        letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        again = np.concatenate([[False], letters[1:] == letters[:-1]])
        kinds += [again.astype(np.int8) + np.int8(1), np.zeros(k + 1, np.int8)]
        sizes.append(2 * k + 1)
        ids.append(path[-1])
    join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0, kind), kind)
    repeated = lambda values: pa.array(np.repeat(np.array(values, np.int64), np.array(sizes, np.int64)))
    return pa.RecordBatch.from_arrays(
        [
            join(befores, pa.int64()), join(afters, pa.int64()), repeated(ids),
            repeated(batch.column("n").to_pylist()), join(kinds, pa.int8()),
        ],
        ["p", "s", "word_id", "n", "kind"],
    )


def near_words(pairs: DataFrame) -> DataFrame:
    """word_id, n_near (how many words are near it), form_n and form_id of the most frequent of them,
    of equally frequent ones the smallest. Words near none have no row."""
    member = F.struct("n", (-F.col("word_id")).alias("rank"), "kind")
    groups = pairs.groupBy("p", "s").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    most_first = F.sort_array("members", asc=False)
    groups = groups.select(
        F.filter(most_first, lambda m: m.kind > 0).alias("skips"),
        F.filter(most_first, lambda m: m.kind == 1).alias("firsts"),
        F.get(F.filter(most_first, lambda m: m.kind == 0), F.lit(0)).alias("whole"),
    )

    def of_longer(m: Column) -> Column:
        other = F.when(F.get("skips", F.lit(0)).rank == m.rank, F.get("skips", F.lit(1))).otherwise(F.get("skips", F.lit(0)))
        shorter = F.when(m.kind == 1, F.col("whole"))
        count = F.size("skips") - 1 + shorter.isNotNull().cast("int")
        return F.struct(m.rank.alias("rank"), count.alias("count"), F.greatest(other, shorter).alias("best"))

    of_shorter = F.when(
        F.col("whole").isNotNull(),
        F.array(F.struct(
            F.col("whole.rank").alias("rank"), F.size("firsts").alias("count"),
            F.get("firsts", F.lit(0)).alias("best"),
        )),
    ).otherwise(F.array())
    found = groups.select(F.inline(F.concat(F.transform("skips", of_longer), of_shorter))).where("count > 0")
    return found.groupBy((-F.col("rank")).alias("word_id")).agg(
        F.sum("count").alias("n_near"),
        F.max(F.struct(F.col("best.n").alias("n"), F.col("best.rank").alias("rank"))).alias("best"),
    ).select("word_id", "n_near", F.col("best.n").alias("form_n"), (-F.col("best.rank")).alias("form_id"))


def last_forms(forms: DataFrame) -> DataFrame:
    """word and root: where its forms lead, from rows of word and form.

    Every step doubles the way gone. A form is several times as frequent as its word, so ways are short
    and the steps few.
    """
    spark, current = forms.sparkSession, materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("via"), F.col("root").alias("next"))
        stepped = current.join(further, F.col("root") == F.col("via"), "left")
        going = stepped.where("next IS NOT NULL").limit(1).count()
        if not going:
            return current
        before, current = current, materialize(
            stepped.select("word", F.coalesce("next", "root").alias("root")), "roots"
        )
        for path in {f.rsplit("/", 1)[0] for f in before.inputFiles()}:
            delete_path(spark, path)


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES, every: int = EVERY
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word: the near word of largest n if that is at
    least `times` the word's own, and where forms lead in the end (the word itself without a form)."""
    words = materialize(word_counts(docs, min_length, min_count, every), "spelling_words")
    return group_words(words, times)


def group_words(words: DataFrame, times: int = TIMES) -> DataFrame:
    """The same from a table of distinct words and their n."""
    forward = trie_paths(words.select("word", "n"), F.col("word"))
    backward = trie_paths(words.select(F.col("word").alias("same")), F.reverse("same"))
    near = materialize(near_words(node_pairs(forward, backward)), "near_words")
    numbered = forward.select("word", "n", F.element_at("path", -1).alias("word_id"))
    known = numbered.join(near, "word_id", "left")
    names = numbered.select(F.col("word").alias("form"), F.col("word_id").alias("form_id"))
    formed = known.where(F.col("form_n") >= times * F.col("n")).select("word", "form_n", "form_id")
    forms = materialize(formed.join(names, "form_id").select("word", "form", "form_n"), "forms")
    rooted = forms.join(last_forms(forms), "word")
    return known.drop("form_n").join(rooted, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"),
    )
