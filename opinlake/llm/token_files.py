"""Token ids in files, with document borders in Elias-Fano code.

Documents are dealt out by ranges of their id and sorted, so the blocks of all parts, one after
the other, are one array of ids in ascending order of documents. A block holds

* the ids, little-endian, in 16 bits if the vocabulary fits, else in 32;
* the end of each document, counted from the start of the block, in Elias-Fano code: the low
  bits of all ends packed side by side, the high bits in unary as one bit string;
* samples of that bit string: the place of every 256th one bit. `BlockBorders.end(i)` goes to the
  sample below `i` and counts bits from there, so a border is found without a table of offsets.

This takes about 2 + log2(ids / documents) bits a document, where offsets take 64. Blocks are
rows of a Parquet table in the shared folder, so the files are written by Spark's committer
(a lost executor's half files never show) and may lie in any store that Spark reaches. What
comes before a block is not in it: the sums over parts and blocks come from the block sizes.

Inputs: a NULL text has only the end id. Rows without an id come first. Rows with the same id
are ordered by their text's hash; all get their own place. Other columns are ignored. A text
longer than a block is a block of its own. No rows make no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, by_size
from opinlake.llm.bpe import codec, default_vocabulary
from opinlake.session import scratch_path

BLOCK_IDS = 1_000_000
SAMPLE_EVERY = 256

BLOCK_SCHEMA = (
    "part int, block int, n_docs int, n_ids long, width int, doc_ids binary, no_id binary,"
    " low_bits int, low binary, high binary, samples binary, ids binary"
)


def encode_borders(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Elias-Fano code of a non-decreasing sequence: low width, low bits, high bits, samples."""
    ends = np.asarray(ends, np.int64)
    if not len(ends):
        return 0, b"", b"", b""
    width = max(0, int(ends[-1] // len(ends)).bit_length() - 1)
    low = ends & ((1 << width) - 1)
    bits = ((low[:, None] >> np.arange(width)) & 1).astype(np.uint8)
    ones = (ends >> width) + np.arange(len(ends))
    high = np.zeros(int(ones[-1]) + 1, np.uint8)
    high[ones] = 1
    return (
        width,
        np.packbits(bits.ravel(), bitorder="little").tobytes(),
        np.packbits(high, bitorder="little").tobytes(),
        ones[::SAMPLE_EVERY].astype("<u4").tobytes(),
    )


class BlockBorders:
    """Reads the borders of one block."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, samples: bytes) -> None:
        self.n, self.width = n, width
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def end(self, i: int) -> int:
        """The end of document `i`: select the `i`-th one bit, then add its low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        left = i % SAMPLE_EVERY
        at = int(self.samples[i // SAMPLE_EVERY])
        byte = at // 8
        window = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        window[: at % 8] = 0
        ones = np.flatnonzero(window)
        while len(ones) <= left:
            left -= len(ones)
            byte += 1
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))
        place = byte * 8 + int(ones[left])
        return ((place - i) << self.width) | self._low(i)

    def _low(self, i: int) -> int:
        value = 0
        for k in range(self.width):
            bit = i * self.width + k
            value |= int(self.low[bit // 8] >> (bit % 8) & 1) << k
        return value

    def start(self, i: int) -> int:
        return self.end(i - 1) if i else 0

    def ends(self) -> np.ndarray:
        """All borders at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.width]
        low = bits.reshape(self.n, self.width).astype(np.int64) @ (1 << np.arange(self.width))
        return ((ones - np.arange(self.n)) << self.width) | low


def write_token_files(
    docs: DataFrame, target: str, path: str | None = None, end_id: int = 2, block_ids: int = BLOCK_IDS
) -> None:
    """Encode all texts and write them with their borders to the folder `target`."""
    path = path or default_vocabulary()
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = (
        keyed.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "tie")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        own = codec(path)
        small = len(own.names) <= 1 << 16 and end_id < 1 << 16
        kind, block = ("<u2" if small else "<u4"), 0
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        count = 0

        def made() -> pa.RecordBatch:
            low_bits, low, high, samples = encode_borders(np.cumsum([len(x) for x in held]))
            row = {
                "part": part, "block": block, "n_docs": len(keys), "n_ids": count,
                "width": np.dtype(kind).itemsize,
                "doc_ids": np.array([k or 0 for k in keys], "<i8").tobytes(),
                "no_id": np.packbits([k is None for k in keys], bitorder="little").tobytes(),
                "low_bits": low_bits, "low": low, "high": high, "samples": samples,
                "ids": np.concatenate(held).astype(kind).tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

        for batch in batches:
            for piece in by_size(batch, "text"):
                coded = own.encode(piece.column(1).to_pylist())
                for key, ids in zip(piece.column(0).to_pylist(), coded, strict=True):
                    keys.append(key)
                    held.append(np.append(ids, np.uint32(end_id)))
                    count += len(held[-1])
                    if count >= block_ids:
                        yield made()
                        keys, held, count, block = [], [], 0, block + 1
        if keys:
            yield made()

    as_bytes(ordered, "doc_id").mapInArrow(run, BLOCK_SCHEMA).write.parquet(target)


_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
        ("width", pa.int32()), ("doc_ids", pa.binary()), ("no_id", pa.binary()),
        ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
        ("samples", pa.binary()), ("ids", pa.binary()),
    ]
)


def read_blocks(spark, target: str) -> DataFrame:
    """The blocks with the number of ids before each (`first_id`).

    Sums within a part by a window over the part's block sizes, sums of parts by one over as
    many rows as there are parts; the ids themselves take no part in either.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(target)
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_first"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_first")
    ).join(parts, "part")
    firsts = firsts.select("part", "block", (F.col("part_first") + F.col("block_first")).alias("first_id"))
    return blocks.join(firsts, ["part", "block"])


def _read(block: dict) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their ends, and the token ids of a block."""
    n = block["n_docs"]
    missing = np.unpackbits(np.frombuffer(block["no_id"], np.uint8), bitorder="little")[:n]
    keys = np.frombuffer(block["doc_ids"], "<i8").tolist()
    names = [None if m else k for k, m in zip(keys, missing, strict=True)]
    borders = BlockBorders(n, block["low_bits"], block["low"], block["high"], block["samples"])
    ids = np.frombuffer(block["ids"], f"<u{block['width']}")
    return names, borders.ends(), ids


def read_documents(spark, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and the ids, end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                names, ends, ids = _read(block)
                starts = np.concatenate([[0], ends[:-1]]) + block["first_id"]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))
                )
                columns = [pa.array(names, pa.int64()), pa.array(starts, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])

    return read_blocks(spark, target).mapInArrow(run, "doc_id long, start long, ids array<int>")


def document_digests(spark, target: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                names, ends, ids = _read(block)
                starts = np.concatenate([[0], ends[:-1]])
                wide = ids.astype("<u4")
                sums = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(starts + block["first_id"], pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read_blocks(spark, target).mapInArrow(run, schema)


def token_file_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write `docs` to token files in the shared folder and read them back."""
    spark = docs.sparkSession
    target = scratch_path(spark, "token_files")
    write_token_files(docs, target, path)
    return document_digests(spark, target)
