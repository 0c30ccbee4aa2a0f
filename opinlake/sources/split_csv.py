"""CSV files with line breaks inside quotes, each read by many tasks.

Spark's own reader gives such a file to one task, since a byte range does not tell whether it starts
inside quotes. Here the lines of all ranges are read in parallel as text. A first scan counts the
quotes of each range; summed up in the order of a file, their parity tells how every range starts. A
second scan joins lines to records wherever the number of quotes so far is even. A record that goes
over the end of its range comes in pieces, which are the only rows that are shuffled.

Quotes must stand for quotes: fields with a quote or a line break are quoted, and quotes inside are
doubled, as CSV writers do. In files whose lines end in CR and LF, quoted line breaks become LF, as with
Spark's reader. The driver receives one row for each range (for each 128 MB or so).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_RECORDS = "record string, file long, block long, piece int, first boolean"
_HEAD, _TAIL = 0, 1  # pieces: the end of a record begun before, the start of one that goes on


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _openings(lines: DataFrame) -> tuple[dict[tuple[int, int], int], set[int], bool]:
    """Whether each range starts inside quotes (1) or not, the files whose lines end in CR and LF by
    their first line, and whether any record comes in pieces."""
    bare = F.replace("value", F.lit('"'), F.lit(""))
    quotes = lines.groupBy("file", "block").agg(
        F.sum(F.length("value") - F.length(bare)).alias("quotes"),
        # A range's lines pass in order.
        ((F.col("block") == 0) & F.first(F.endswith("value", F.lit("\r")))).alias("with_cr"),
    )
    so_far = Window.partitionBy("file").orderBy("block")
    # One row for each range: the number of bytes bounds them.
    found = quotes.select(
        "file", "block", "quotes", "with_cr", (F.sum("quotes").over(so_far) % 2).alias("closes")
    ).collect()
    starts = {(r["file"], r["block"]): int((r["closes"] - r["quotes"]) % 2) for r in found}
    with_cr = {r["file"] for r in found if r["with_cr"]}
    return starts, with_cr, any(starts.values()) or any(r["closes"] for r in found)


class _Cutter:
    """Lines of one range, joined to records as they come; with `pieces`, only a first record that
    began before the range and a last one that goes on after it."""

    def __init__(self, file: int, block: int, opened: int, with_cr: bool, pieces: bool) -> None:
        self.file, self.block, self.opened, self.with_cr = file, block, opened, with_cr
        self.pieces = pieces
        self.head, self.first = bool(opened), block == 0
        self.held: list[pa.Array] = []

    def _batch(self, records: pa.Array, piece: int | None) -> pa.RecordBatch:
        n = len(records)
        pieces = np.full(n, -1 if piece is None else piece, np.int32)
        whole = np.arange(n) > 0 if piece == _HEAD else np.full(n, piece is None)
        first = np.zeros(n, bool)
        first[:1], self.first = self.first, False
        return pa.RecordBatch.from_arrays(
            [
                records, pa.array(np.full(n, self.file)), pa.array(np.full(n, self.block)),
                pa.array(pieces, mask=whole), pa.array(first),
            ],
            ["record", "file", "block", "piece", "first"],
        )

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """Records that end among these lines."""
        if self.with_cr:
            lines = pc.replace_substring_regex(lines, "\r$", "")
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        inside = (self.opened + np.cumsum(quotes)) % 2
        self.opened = int(inside[-1])
        ends = np.flatnonzero(inside == 0) + 1
        if len(ends) and self.pieces and not self.head:
            self.held, self.first = [], False
            lines = lines.slice(int(ends[-1]))
        elif len(ends):
            last = int(ends[-1])
            ends = ends[:1] if self.pieces else ends
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            grouped = pa.ListArray.from_arrays(offsets, lines.slice(0, int(ends[-1])))
            records = pc.binary_join(grouped, "\n")
            if self.held:
                begun = "\n".join([x for part in self.held for x in part.to_pylist()])
                records = pa.concat_arrays(
                    [pa.array([f"{begun}\n{records[0].as_py()}"], records.type), records.slice(1)]
                )
            yield self._batch(records, _HEAD if self.head else None)
            self.head, self.held = False, []
            lines = lines.slice(last)
        if len(lines):
            self.held.append(lines)

    def end(self) -> Iterator[pa.RecordBatch]:
        """What is left when the range ends."""
        if self.held:
            text = "\n".join([x for part in self.held for x in part.to_pylist()])
            yield self._batch(pa.array([text], pa.string()), _HEAD if self.head else _TAIL)


def _cut(
    lines: DataFrame, starts: dict[tuple[int, int], int], with_cr: set[int], pieces: bool
) -> DataFrame:
    known = lines.sparkSession.sparkContext.broadcast((starts, with_cr))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, with_cr = known.value
        cutter = None
        for batch in batches:
            file, block = (batch.column(k).to_numpy() for k in (1, 2))
            turns = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *turns], [*turns, len(file)], strict=True):
                if a == b:
                    continue
                own = int(file[a]), int(block[a])
                if cutter is None or (cutter.file, cutter.block) != own:
                    if cutter is not None:
                        yield from cutter.end()
                    if own not in starts:
                        raise RuntimeError("files or ranges have changed while they were read")
                    cutter = _Cutter(*own, starts[own], own[0] in with_cr, pieces)
                yield from cutter.add(batch.column(0).slice(int(a), int(b - a)))
        if cutter is not None:
            yield from cutter.end()

    return lines.mapInArrow(run, _RECORDS)


def _join_pieces(pieces: DataFrame) -> DataFrame:
    """Records from their pieces: a tail and the heads that follow it in the file."""
    so_far = Window.partitionBy("file").orderBy("block", "piece")
    number = F.sum((F.col("piece") == _TAIL).cast("int")).over(so_far)
    ordered = F.array_sort(F.collect_list(F.struct("block", "piece", "record")))
    return pieces.withColumn("number", number).groupBy("file", "number").agg(
        F.array_join(F.transform(ordered, lambda p: p.record), "\n").alias("record"),
        F.max("first").alias("first"),
    )


def read_split_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of CSV files with a header line each, every file read by as many tasks as it has
    ranges."""
    lines = _lines(spark, path)
    starts, with_cr, in_pieces = _openings(lines)
    records = _cut(lines, starts, with_cr, False).where("piece IS NULL AND NOT first").select("record")
    if in_pieces:
        pieces = _cut(lines, starts, with_cr, True)
        joined = _join_pieces(pieces.where("piece IS NOT NULL"))
        records = records.union(joined.where("NOT first").select("record"))
    record = F.col("record")
    options = {"escape": '"', "multiLine": "true"}
    rows = records.where(record != "").select(F.from_csv(record, schema.toDDL(), options).alias("row"))
    return rows.select("row.*")
