"""Dense statistics of texts, computed for many texts at once as array operations over bytes."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Second person in the languages of the data and some others: fixed values.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
    " vuestro du dich dir dein deine deiner ihr euch euer eure sie ihnen".split()
)
NEAR_WORDS = 6  # how close an insult and a second person stand to count as addressed

STATS = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "upper_share", "digit_share", "mark_share",
    "exclaim_share", "question_share", "bar_share", "symbol_share", "blank_share", "beyond_ascii",
    "stop_share", "repeat_share", "distinct_share", "line_repeat_share", "log_longest_word",
    "long_word_share", "short_line_share",
)
TOXIC_STATS = (
    "lexicon_share", "log_lexicon", "lexicon_distinct", "second_person_share", "addressed_share",
    "shouted_share", "obfuscated_share", "stretched_share",
)

_LEET = str.maketrans("0134578@$!|+", "oieastbasiit")
_OBFUSCATED = re.compile(rb"[a-z0-9@$!|+]*(?:[a-z][0134578@$!|+]+[a-z]|[0134578@$!|+][a-z]+[0134578@$!|+])[a-z0-9@$!|+]*")
_SPACED = re.compile(rb"(?<![a-z0-9])(?:[a-z][ .\-*_]){2,}[a-z](?![a-z0-9])")
_STRETCHED = re.compile(rb"([a-z])\1{3,}")


def _kind(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_UPPER = _kind(bytes(range(65, 91)))
_LETTER = _kind(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_DIGIT = _kind(b"0123456789")
_BLANK = _kind(b" \t\n\v\f\r")
_MARK = _kind(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_SYMBOL = _kind(b"#$%&*+<=>@[\\]^_`{}~")
_BEYOND = _kind(bytes(range(128, 256)))
# Second bytes of upper-case letters from U+00C0 on, behind the byte 0xC3.
_UPPER_TAIL = _kind(bytes(range(0x80, 0x9F)))


def _per_text(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(np.append(sums[firsts], sums[-1])).astype(np.float64)


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return turns[::2], turns[1::2]


def _encode(held: np.ndarray, inside: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.DictionaryArray:
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    packed = pa.py_buffer(held[inside])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), packed]).dictionary_encode()


def measure(texts: list[bytes], insult: Callable[[str], bool] | None = None) -> np.ndarray:
    """A row for each text: `STATS`, and with an insult test `TOXIC_STATS` after them."""
    if not texts:
        return np.zeros((0, len(STATS) + (len(TOXIC_STATS) if insult else 0)))
    joined = b"\n".join(texts) + b"\n"
    held = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.cumsum(lengths + 1) - lengths - 1
    n = len(texts)
    size = np.maximum(lengths, 1).astype(np.float64)
    share = lambda table: _per_text(table[held], firsts) / size
    upper = _UPPER[held]
    upper[1:] |= (held[:-1] == 0xC3) & _UPPER_TAIL[held[1:]]
    letters = np.maximum(_per_text(_LETTER[held], firsts), 1)

    inside = ~_BLANK[held]
    starts, stops = _runs(inside)
    words = _encode(held, inside, starts, stops)
    codes = words.indices.to_numpy().astype(np.int64)
    text_of = np.searchsorted(firsts, starts, "right") - 1
    count = lambda where: np.bincount(where, minlength=n).astype(np.float64)
    n_words = count(text_of)
    safe = np.maximum(n_words, 1)
    again = np.flatnonzero((codes[1:] == codes[:-1]) & (text_of[1:] == text_of[:-1])) + 1
    pairs = np.unique(text_of * np.int64(len(words.dictionary) + 1) + codes)
    distinct = count((pairs // (len(words.dictionary) + 1)).astype(np.int64))
    long_ = (stops - starts) >= 20
    longest = np.zeros(n)
    np.maximum.at(longest, text_of, (stops - starts).astype(np.float64))

    rows = [text.split(b"\n") for text in texts]
    n_lines = np.fromiter(map(len, rows), np.float64, n)
    same_lines = np.array([1 - len(set(r)) / len(r) for r in rows])
    short_lines = np.array([sum(len(x) < 20 for x in r) / len(r) for r in rows])
    columns = [
        np.log1p(lengths), np.log1p(n_words), np.log1p(n_lines), (lengths - n_words) / safe,
        _per_text(upper, firsts) / letters, share(_DIGIT), share(_MARK), share(_kind(b"!")),
        share(_kind(b"?")), share(_kind(b"|")), share(_SYMBOL),
        (_per_text(_BLANK[held], firsts) - 1) / size, share(_BEYOND), share(_kind(b".")),
        count(text_of[again]) / safe, distinct / safe, same_lines, np.log1p(longest),
        count(text_of[long_]) / safe, short_lines,
    ]
    if insult is not None:
        columns += _toxic(texts, joined, firsts, insult)
        columns += _disguised(texts, words.dictionary.to_pylist(), codes, text_of, n_words, insult)
    return np.column_stack(columns)


def _toxic(texts: list[bytes], joined: bytes, firsts: np.ndarray, insult: Callable[[str], bool]) -> list[np.ndarray]:
    n, low = len(texts), joined.lower()
    held = np.frombuffer(low, np.uint8)
    inside = _LETTER[held]
    starts, stops = _runs(inside)
    words = _encode(held, inside, starts, stops)
    codes = words.indices.to_numpy()
    names = [w.decode("utf-8", "replace").lower() for w in words.dictionary.to_pylist()]
    bad = np.fromiter(map(insult, names), bool, len(names))
    you = np.fromiter((w in SECOND_PERSON for w in names), bool, len(names))
    text_of = np.searchsorted(firsts, starts, "right") - 1
    count = lambda where: np.bincount(where, minlength=n).astype(np.float64)
    n_words = np.maximum(count(text_of), 1)
    hits, persons = np.flatnonzero(bad[codes]), np.flatnonzero(you[codes])
    n_hits = count(text_of[hits])
    found = np.unique(np.column_stack([text_of[hits], codes[hits]]), axis=0)[:, 0] if len(hits) else hits
    near = np.zeros(len(hits), bool)
    if len(persons) and len(hits):
        at = np.searchsorted(persons, hits)
        for side in (np.clip(at - 1, 0, len(persons) - 1), np.clip(at, 0, len(persons) - 1)):
            other = persons[side]
            near |= (np.abs(other - hits) <= NEAR_WORDS) & (text_of[other] == text_of[hits])
    raw = np.frombuffer(joined, np.uint8)
    capital = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    shouted = (capital[stops] - capital[starts] == stops - starts) & (stops - starts >= 4)
    return [
        n_hits / n_words, np.log1p(n_hits), count(found.astype(np.int64)), count(text_of[persons]) / n_words,
        count(text_of[hits[near]]) / n_words, count(text_of[np.flatnonzero(shouted)]) / n_words,
    ]


def _disguised(
    texts: list[bytes], words: list[bytes], codes: np.ndarray, text_of: np.ndarray, n_words: np.ndarray,
    insult: Callable[[str], bool],
) -> list[np.ndarray]:
    """Rates of disguised and of stretched spellings: looked for once in each distinct word, and
    for letters set apart in the whole text."""
    hidden, stretched = np.zeros(len(words)), np.zeros(len(words))
    for k, word in enumerate(words):
        lower = word.lower()
        if not lower.isalpha():
            for piece in _OBFUSCATED.findall(lower):
                hidden[k] += insult(piece.decode("ascii").translate(_LEET))
        stretched[k] = len(_STRETCHED.findall(lower))
    total = np.bincount(text_of, hidden[codes], len(texts))
    for k, text in enumerate(texts):
        for piece in _SPACED.findall(text.lower()):
            total[k] += insult(re.sub("[^a-z]", "", piece.decode("ascii")))
    safe = np.maximum(n_words, 1)
    return [total / safe, np.bincount(text_of, stretched[codes], len(texts)) / safe]
