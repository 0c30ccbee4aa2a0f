"""Encoding and decoding with a byte-pair vocabulary: speculate, verify, merge what is left.

A text is cut where no token crosses, at ASCII white space and, in simple texts, between letters
and marks; each distinct piece is encoded once and remembered. A new piece is cut into words by the vocabulary's own rules, and
for every word, greedy longest match proposes tokens. The proposal is the result of merging exactly
when each of its tokens is what its own text merges to and every two neighbours are compatible:
no merge across their border would have come before the merges that built them. Compatibility
is tested for all neighbours of all new words at once, as array operations over the merge table.
Words with an incompatible pair, and only those, are merged step by step by the library's model.

Inputs: NULL text is an empty one and has no tokens. Rows come back one for one, with their
document id whatever it is (NULL, repeated); other columns are ignored. Very long texts are
worked on alone; what is remembered is bounded by `CACHE_ENTRIES`.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import SLICE_BYTES, as_bytes, map_slices

CACHE_ENTRIES = 350_000
NEVER = np.int64(1) << 40

# The vocabulary's word pattern over the characters below `PLAIN_LIMIT` after lower-casing; its
# classes are spelled out, as Python's own differ. All those characters are composed already,
# and so are their lower cases; texts with others go through the library's own rules.
PLAIN_LIMIT = 0x180
_PLAIN_TEXT = re.compile(f"[\\x00-{chr(PLAIN_LIMIT - 1)}]*")


def _plain_word() -> re.Pattern[str]:
    plain = [chr(k) for k in range(PLAIN_LIMIT)]
    kinds = {k: "".join(c for c in plain if unicodedata.category(c)[0] == k) for k in "LN"}
    return re.compile(
        f"[{kinds['L']}]+|'(?:s|t|re|ve|m|ll|d)|[{kinds['N']}]"
        f"|[^\\x09-\\x0d\\x20\\x85\\xa0{kinds['L']}{kinds['N']}]+"
    )


_PLAIN_WORD = _plain_word()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable in Latin-1, else the next free character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in table]
    return table | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


def _piece_kinds() -> np.ndarray:
    kinds = np.ones(256, np.int8)  # letters, digits, the apostrophe, bytes beyond ASCII
    kinds[[b for b in range(128) if not chr(b).isalnum() and chr(b) != "'"]] = 2
    kinds[[*b"\t\n\v\f\r "]] = 0
    return kinds


# In simple texts no word crosses white space or a border between these two kinds of bytes:
# outside ASCII they have letters only, and apostrophes never touch other marks.
PIECE_KIND = _piece_kinds()
_LETTERS = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
_MARKS = "[^\\x80-\\xffA-Za-z0-9'\\s]".encode()
_TOUCHING = re.compile(b"'" + _MARKS + b"|" + _MARKS + b"'|<\\|")


def is_simple(text: bytes) -> bool:
    return not _TOUCHING.search(text) and (
        text.isascii() or _LETTERS.fullmatch(text.decode("utf-8")) is not None
    )


class MergeTable:
    """The merges as arrays: what a token was made of, and when."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        size = max(vocab.values()) + 1
        self.size = size
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.rank = np.full(size, -1, np.int64)  # -1: a single symbol
        pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            made, x, y = vocab[a + b], vocab[a], vocab[b]
            pairs.setdefault(x * size + y, rank)
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = x, y, rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(pairs.values(), np.int64, len(pairs))[order]

    def joined_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, `NEVER` where there is none."""
        key = a * self.size + b
        if not len(self.keys):
            return np.full(len(key), NEVER)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether `a` and `b` stay apart when their joined text is merged.

        The merges of both are undone, latest first (of equal ones the right one, since
        merging goes from left to right). Whenever the two symbols that then face each other
        have a merge that comes before the one just undone, that merge would have been made.
        """
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        limit = np.full(len(a), NEVER) if limit is None else np.array(limit, np.int64)
        good = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            clash = self.joined_rank(x, y) < limit[open_]
            good[open_[clash]] = False
            rx, ry = self.rank[x], self.rank[y]
            goes_on = ~clash & (np.maximum(rx, ry) >= 0)
            open_, x, y, rx, ry = open_[goes_on], x[goes_on], y[goes_on], rx[goes_on], ry[goes_on]
            undo_left = rx > ry
            limit[open_] = np.where(undo_left, rx, ry + 1)
            a[open_] = np.where(undo_left, self.right[x], x)
            b[open_] = np.where(undo_left, y, self.left[y])
        return good

    def stable(self) -> np.ndarray:
        """Tokens whose own text merges to just them; no other can be in a result."""
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        good = np.ones(self.size, bool)
        good[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for token in made:
            good[token] &= good[self.left[token]] & good[self.right[token]]
        return good


class BpeCodec:
    """Encoder and decoder for one vocabulary file, with what it has encoded before."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile(f"({'|'.join(added)})") if added else None
        self.table = MergeTable(vocab, merges)
        stable = self.table.stable()
        self.pieces = {text: k for text, k in vocab.items() if stable[k]}
        self.reach: dict[str, int] = {}
        for text in self.pieces:
            bare = len(text.removesuffix(self.suffix))
            self.reach[text[:3]] = max(bare, self.reach.get(text[:3], 2))
            if text.endswith(self.suffix):
                start = text.removesuffix(self.suffix)[:3]
                self.reach[start] = max(bare, self.reach.get(start, 2))
        self.ends = np.zeros(self.table.size, bool)
        self.ends[[k for text, k in vocab.items() if text.endswith(self.suffix)]] = True
        names = {k: text for text, k in vocab.items()}
        names |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = [names.get(k, "") for k in range(max(names) + 1)]
        self.decimals = [str(k) for k in range(len(self.names))]
        # Step by step merging of given words: the same model without any text rules.
        self.merger = Tokenizer(models.BPE(vocab, merges, end_of_word_suffix=self.suffix))
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.bytes_shown = byte_alphabet()
        self.known: dict[bytes, bytes] = {}
        self.speculated = self.failed = 0

    # -- words of a piece

    def words(self, text: str) -> list[str]:
        """The words of a piece, in the byte alphabet of the vocabulary."""
        if _PLAIN_TEXT.fullmatch(text):
            found = _PLAIN_WORD.findall(text.lower())
            if text.isascii() and text.isprintable():
                return found
            return [w.encode().decode("latin-1").translate(self.bytes_shown) for w in found]
        text = self.library.normalizer.normalize_str(text)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    # -- speculation

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; the last token ends with the word."""
        found, at, size, pieces, reach = [], 0, len(word), self.pieces, self.reach
        while True:
            # No token with these first characters is longer than this.
            stop = at + reach.get(word[at : at + 3], 2)
            if stop >= size:
                last = pieces.get(word[at:] + self.suffix)
                if last is not None:
                    found.append(last)
                    return found
                stop = size - 1
            token = pieces.get(word[at:stop])
            while token is None:
                stop -= 1
                token = pieces.get(word[at:stop])
            found.append(token)
            at = stop

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The tokens of each word, as 32-bit integers."""
        if not words:
            return []
        proposals = list(map(self.propose, words))
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        stops = np.cumsum(sizes)
        word_of = np.repeat(np.arange(len(words)), sizes)
        same = np.flatnonzero(word_of[1:] == word_of[:-1])
        keys, back = np.unique(flat[same] * self.table.size + flat[same + 1], return_inverse=True)
        fine = self.table.compatible(keys // self.table.size, keys % self.table.size)
        failing = np.unique(word_of[same[~fine[back]]])
        self.speculated += len(words)
        self.failed += len(failing)
        tokens = _cut(flat, stops)
        for k, exact in zip(failing, self.merge([words[k] for k in failing]), strict=True):
            tokens[k] = exact
        return tokens

    def merge(self, words: list[str]) -> list[bytes]:
        """Exact merging; the ends of words are where tokens carry the end mark."""
        if not words:
            return []
        coded = self.merger.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(coded.ids, np.int64)
        return _cut(ids, np.flatnonzero(self.ends[ids]) + 1)

    # -- texts

    def learn(self, fresh: Iterable[bytes]) -> None:
        """Encode pieces not seen before."""
        cut: dict[bytes, list[str]] = {}
        for piece in fresh:
            if piece.isalpha():  # ASCII letters alone are one word
                cut[piece] = [piece.lower().decode("ascii")]
                continue
            text = piece.decode("utf-8")
            if self.special is not None and self.special.search(text):
                # Special tokens are matched in the text as it is, before any rule.
                ids = self.library.encode(text, add_special_tokens=False).ids
                self.known[piece] = np.array(ids, "<u4").tobytes()
            else:
                cut[piece] = self.words(text)
        words = list(dict.fromkeys(chain.from_iterable(cut.values())))
        coded = self.encode_words(words)
        tokens = dict(zip(words, coded, strict=True))
        for piece, found in cut.items():
            self.known[piece] = b"".join(map(tokens.__getitem__, found))

    def recall(self, pieces: list[bytes]) -> list[bytes]:
        """The tokens of each of some distinct pieces."""
        fresh = [piece for piece in pieces if piece not in self.known]
        if len(fresh) + len(self.known) > CACHE_ENTRIES:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        self.learn(fresh)
        return [self.known[piece] for piece in pieces]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The token ids of each text."""
        found: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        simple = []
        for k, text in enumerate(texts):
            if is_simple(text):
                simple.append(k)
            else:
                pieces = text.split()
                known = dict(zip(distinct := list(set(pieces)), self.recall(distinct), strict=True))
                found[k] = np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u4")
        if simple:
            for k, ids in zip(simple, self.encode_simple([texts[k] for k in simple]), strict=True):
                found[k] = ids
        return found

    def encode_simple(self, texts: list[bytes]) -> list[np.ndarray]:
        """Many simple texts at once: cut as an array of bytes, each distinct piece looked up
        once, and its tokens copied to all its places."""
        held = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
        kind = PIECE_KIND[held]
        turns = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        turns = np.concatenate([[0], turns, [len(held)]])
        inside = kind[turns[:-1]] > 0
        starts, sizes = turns[:-1][inside], np.diff(turns)[inside]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        array = pa.Array.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(held[kind > 0])]
        ).dictionary_encode()
        coded = self.recall(array.dictionary.to_pylist())
        codes = array.indices.to_numpy()
        tokens = np.frombuffer(b"".join(coded), "<u4")
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        before = np.concatenate([[0], np.cumsum(counts)])
        lengths = counts[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = tokens[np.arange(ends[-1]) + np.repeat(before[codes] - ends[:-1], lengths)]
        borders = np.cumsum([len(t) + 1 for t in texts[:-1]], dtype=np.int64)
        return np.split(ids, ends[np.searchsorted(starts, borders)])

    def decode(self, ids: np.ndarray) -> str:
        """As the library without a decoder: the tokens' texts with blanks between them."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _cut(ids: np.ndarray, stops: np.ndarray) -> list[bytes]:
    held, ends = ids.astype("<u4").tobytes(), (4 * stops).tolist()
    return [held[a:b] for a, b in zip([0, *ends], ends, strict=False)]


_codecs: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """One codec for each worker process and vocabulary file."""
    if path not in _codecs:
        _codecs[path] = BpeCodec(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and its token ids, one row for each row of `docs`."""
    path = path or default_vocabulary()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coded = codec(path).encode(batch.column(1).to_pylist())
        ids = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, coded)]), pa.int32()),
            pa.array(np.concatenate(coded).astype(np.int32)),
        )
        return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return map_slices(_keyed(docs), work, "doc_id long, ids array<int>")


def decode_documents(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text its ids stand for."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = (np.array(x if x is not None else [], np.int64) for x in batch.column(1).to_pylist())
            texts = pa.array([codec(path).decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, the number of tokens and the digests of the ids and of the decoded text.

    The ids and the decoded text are made and digested in the same task, so neither is moved.
    """
    path = path or default_vocabulary()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        counts, coded, decoded = [], [], []
        for ids in own.encode(batch.column(1).to_pylist()):
            counts.append(len(ids))
            listed = " ".join(map(own.decimals.__getitem__, ids.tolist()))
            coded.append(hashlib.sha256(listed.encode()).hexdigest())
            decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)]
        return pa.RecordBatch.from_arrays(
            columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    # Ids as text and decoded text are held, too.
    return map_slices(_keyed(docs), work, schema, limit=SLICE_BYTES // 4)


def _keyed(docs: DataFrame) -> DataFrame:
    return as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
