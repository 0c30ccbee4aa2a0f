"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, and a span
classifier learns from the weighted votes.

1. Candidates are found by wide patterns: the four strict kinds, also where their checks fail, and
   written-out addresses, local phone numbers, IPv6, account numbers, social security numbers, secrets.
2. Labelers vote for, against or not at all on each candidate: by its pattern and checks, by gazetteers
   (top-level domains, calling codes, issuer numbers, account countries) and by the words around it.
3. Expectation-maximisation over the counts of all vote patterns of all candidates, kind by kind, gives
   each labeler's rates of votes for true and for false candidates, and with them the probability that
   a candidate is true. There are at most 3 to the number of labelers patterns a kind, so the counts fit
   the driver however many candidates there are.
4. A logistic span classifier learns these probabilities from the look of spans and of the characters
   and words beside them, on at most `limit` distinct candidates, picked by hash.

A candidate that the classifier gives 0.5 or more is a span. The four strict kinds (`BASE`) are spans
in any case; others that overlap one of these, or a span before them, are left out.

Two passes over the texts, one to fit, one to find; nothing of the texts is shuffled. Candidates are
held as a table between votes and fit, which is deleted then.

Inputs: NULL text is empty; empty texts have no spans. Each row is decided by its own text, so NULL or
repeated ids and repeated rows do no harm. Texts are worked on whole, each pattern in linear time. No
rows, or none with a candidate, leave a model that adds no spans. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, map_slices
from opinlake.session import delete_path, materialize

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")
MAX_SPANS = 10_000
THRESHOLD = 0.5
_SHARES = 1 << 40
BEFORE, AFTER = 40, 24  # characters around a span that labelers see

Span = tuple[int, int, str]

# -- strict patterns

# Each finds what its plain form finds, leftmost and greedy, in linear time: a run that cannot start a
# match is not tried again from its middle. A pattern that begins with its characters is searched for
# faster than one that begins with a look behind.
_LOCAL = r"[A-Za-z0-9._%+-]"
_MAIL = _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_MAIL_HERE, _MAIL_NEXT = re.compile(_MAIL), re.compile(f"(?<!{_LOCAL})" + _MAIL)
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")


def _mails(text: str) -> Iterator[Span]:
    at = 0
    while found := (_MAIL_HERE.match(text, at) if at else None) or _MAIL_NEXT.search(text, at):
        at = found.end()
        yield found.start(), at, "email"


def _digits(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def passes(kind: str, value: str) -> bool:
    """The check of a strict kind."""
    if kind == "ip":
        parts = [p.lstrip("0") for p in value.split(".")]
        return all(len(p) < 3 or len(p) == 3 and int(p) <= 255 for p in parts)
    digits = _digits(value)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def strict_matches(text: str) -> list[Span]:
    """What the strict patterns find, checks not applied."""
    found = list(_mails(text)) if "@" in text else []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return found


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# -- wide patterns

_WRITTEN = re.compile(
    r"\s?(?:\[at\]|\(at\)|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\[dot\]|\(dot\)|\sdot\s)\s?[A-Za-z]{2,24})+", re.I
)
_LOCAL_END = re.compile(f"{_LOCAL}+$")
_WIDE = (
    ("phone", re.compile(
        r"[0-9(](?<![0-9A-Za-z+(.-][0-9(])(?:(?<=0)0[ .-]?\(?[0-9]{2,4}|(?<=[0-9])[0-9]{1,3}|(?<=\()[0-9]{2,4})"
        r"\)?[ .-][0-9]{3}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![0-9A-Za-z])"
    )),
    ("iban", re.compile(r"[A-Z]{2}[0-9]{2}(?<![A-Za-z0-9]....)(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", re.S)),
    ("ssn", re.compile(r"[0-9]{3}(?<![0-9-][0-9]{3})-[0-9]{2}-[0-9]{4}(?![0-9-])")),
)
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_FROM_DIGIT = re.compile(r"[0-9][A-Za-z0-9+/_-]*+={0,2}")
_IN_SECRET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_SECRET_LENGTH = 20


def _secrets(text: str) -> Iterator[Span]:
    """Long runs of the characters of keys, one digit at least."""
    for found in _FROM_DIGIT.finditer(text):
        start = found.start()
        while start and text[start - 1] in _IN_SECRET:
            start -= 1
        if found.end() - start >= _SECRET_LENGTH:
            yield start, found.end(), "secret"


def _written_mails(text: str) -> Iterator[Span]:
    if "dot" not in text.lower():
        return
    for found in _WRITTEN.finditer(text):
        local = _LOCAL_END.search(text[max(0, found.start() - 64) : found.start()])
        if local:
            yield found.start() - len(local[0]), found.end(), "email"


def candidates(text: str) -> list[Span]:
    """All spans that the labelers vote on, in order."""
    found = strict_matches(text)
    found += [*_written_mails(text), *_secrets(text)]
    if text.count(":") >= 7:
        found += [(m.start(), m.end(), "ip") for m in _IPV6.finditer(text)]
    for kind, pattern in _WIDE:
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return in_order(list(dict.fromkeys(found)))


# -- labelers

# Gazetteers and context words: fixed values.
TOP_LEVEL = frozenset("com org net edu gov io co info biz de fr es it uk us eu ch at nl be pl ca au jp cn in br mx ru se no dk fi pt ie nz".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "353", "358", "380", "420")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
ACCOUNT_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split())
FOR_WORDS = {
    "email": "mail email e-mail contact contacto kontakt courriel correo write reach adresse".split(),
    "ip": "ip host server address addr login logged client from ping subnet adresse".split(),
    "card": "card visa mastercard amex credit debit carte tarjeta karte kreditkarte payment pay".split(),
    "phone": "phone tel telephone call mobile cell fax teléfono telefon téléphone móvil handy whatsapp ring".split(),
    "iban": "iban account konto compte cuenta bank bic transfer".split(),
    "ssn": "ssn social security insured taxpayer".split(),
    "secret": "token key secret password passwd pwd apikey api_key bearer auth authorization credential".split(),
}
AGAINST_WORDS = frozenset(
    "version release build isbn issn doi order invoice ticket page chapter section figure table article"
    " commit sha sha1 sha256 md5 hash checksum digest revision uuid serial part item model".split()
)
_WORD = re.compile(r"[^\W\d_][\w-]*")

Labeler = Callable[[str, str, str, str], int]


def _by_pattern(kind: str, value: str, before: str, after: str) -> int:
    """The strict form with its check, or a wide form."""
    whole = [s for s in strict_matches(value) if s[2] == kind and s[:2] == (0, len(value))]
    return 1 if whole and passes(kind, value) else -1 if whole else 0


def _by_checksum(kind: str, value: str, before: str, after: str) -> int:
    if kind == "card":
        return 1 if luhn(_digits(value)) else -1
    if kind == "iban":
        bare = value.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1 else -1
    if kind == "ssn":
        area, group, serial = value.split("-")
        return -1 if area in ("000", "666") or area > "899" or group == "00" or serial == "0000" else 1
    if kind == "phone":
        return 1 if 9 <= len(_digits(value)) <= 15 else -1
    if kind == "ip" and "." in value:
        return -1 if not passes(kind, value) or any(len(p) > 1 and p[0] == "0" for p in value.split(".")) else 1
    return 0


def _by_gazetteer(kind: str, value: str, before: str, after: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^a-z0-9]+", value.lower().rstrip("])"))[-1] in TOP_LEVEL else -1
    if kind == "phone":
        if not value.startswith(("+", "00")):
            return 0
        return 1 if _digits(value).removeprefix("00").startswith(CALLING_CODES) else -1
    if kind == "card":
        return 1 if value.startswith(ISSUERS) else -1
    if kind == "iban":
        return 1 if value[:2] in ACCOUNT_COUNTRIES else -1
    if kind == "ip" and "." in value:
        return -1 if value.startswith(("0.", "255.")) or value.startswith("1.0.") else 0
    return 0


def _by_words_for(kind: str, value: str, before: str, after: str) -> int:
    near = {w.lower() for w in _WORD.findall(before)[-4:] + _WORD.findall(after)[:2]}
    return 1 if near.intersection(FOR_WORDS[kind]) else 0


def _by_words_against(kind: str, value: str, before: str, after: str) -> int:
    return -1 if AGAINST_WORDS.intersection(w.lower() for w in _WORD.findall(before)[-2:]) else 0


def _by_border(kind: str, value: str, before: str, after: str) -> int:
    """Whether the span stands by itself."""
    glued = before[-1:].isalnum() or after[:1].isalnum() or after[:1] in "@" and bool(after)
    dotted = kind in ("ip", "phone", "card") and (re.match(r"[.-]\d", after) or re.search(r"\d[.-]$", before))
    return -1 if glued or dotted else 1


def _by_variety(kind: str, value: str, before: str, after: str) -> int:
    """Constant or counting characters are fill, not data."""
    plain = re.sub(r"[^0-9A-Za-z]", "", value)
    if len(set(plain)) <= 2 or plain in "01234567890123456789":
        return -1
    return 1 if kind == "secret" and len(set(plain)) >= 10 and any(c.isdigit() for c in plain) and not plain.isdigit() else 0


def _by_layout(kind: str, value: str, before: str, after: str) -> int:
    """Groups of digits as people write them; one kind of separator."""
    if kind not in ("card", "phone"):
        return 0
    groups = [len(g) for g in re.findall("[0-9]+", value)]
    if kind == "card":
        return 1 if groups in ([16], [15], [4, 4, 4, 4], [4, 6, 5]) else -1
    return 1 if 2 <= len(groups) <= 6 and max(groups) <= 7 and groups[-1] >= 2 else -1


LABELERS: tuple[Labeler, ...] = (
    _by_pattern, _by_checksum, _by_gazetteer, _by_words_for, _by_words_against, _by_border, _by_variety, _by_layout,
)


def votes_on(kind: str, value: str, before: str, after: str) -> tuple[int, ...]:
    return tuple(labeler(kind, value, before, after) for labeler in LABELERS)


def around(text: str, span: Span) -> tuple[str, str, str]:
    """A span's characters and some on either side."""
    start, end, _ = span
    return text[start:end], text[max(0, start - BEFORE) : start], text[end : end + AFTER]


# -- reliabilities


@dataclass
class Reliability:
    """Of one kind: the share of true candidates, and each labeler's rates of votes -1, 0 and 1 on false
    (row 0) and true ones (row 1)."""

    prior: float
    rates: np.ndarray

    def probability(self, votes: np.ndarray) -> np.ndarray:
        """That candidates with these votes (a row each) are true."""
        own = np.arange(votes.shape[1])
        logs = np.log(self.rates)
        false, true = (logs[own, c, votes + 1].sum(axis=1) for c in (0, 1))
        return 1 / (1 + np.exp(np.clip(false - true + np.log((1 - self.prior) / self.prior), -500, 500)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Reliability:
    """Expectation-maximisation from vote patterns and how many candidates have each.

    It starts from the sum of votes, so true means what most labelers mean by it; a few made-up votes
    keep each labeler on the side that it votes for where there is next to no data.
    """
    n = votes.shape[1]
    is_true = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    one_hot = (votes[:, :, None] + 1 == np.arange(3)).astype(float)
    made_up = np.array([[2.0, 2.0, 1.0], [1.0, 2.0, 2.0]])
    for _ in range(rounds):
        weight = np.column_stack([counts * (1 - is_true), counts * is_true])
        rates = np.einsum("pc,pjv->jcv", weight, one_hot) + made_up
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (weight[:, 1].sum() + 1) / (weight.sum() + 2)
        model = Reliability(float(prior), rates.reshape(n, 2, 3))
        before, is_true = is_true, model.probability(votes)
        if np.abs(is_true - before).max(initial=0) < 1e-9:
            break
    return model


# -- the span classifier

_HASHED = 32


def features(kind: str, value: str, before: str, after: str) -> list[float]:
    """The look of a span and of what stands beside it, and no votes."""
    n = len(value)
    digits, letters = sum(c.isdigit() for c in value), sum(c.isalpha() for c in value)
    groups = [len(g) for g in re.findall("[0-9]+", value)] or [0]
    words = _WORD.findall(before)[-2:]
    hashed = [0.0] * _HASHED
    for word in words:
        hashed[zlib.crc32(f"{kind}:{word.lower()}".encode()) % _HASHED] = 1.0
    beside = []
    for c in (before[-1:], after[:1]):
        beside += [not c, c.isspace(), c.isalpha(), c.isdigit(), bool(c) and not c.isspace() and not c.isalnum()]
    look = [
        np.log1p(n), digits / n, letters / n, sum(c.isupper() for c in value) / n, len(set(value)) / n,
        np.log1p(max(groups)), np.log1p(len(groups)), value[0] == "+", "(" in value, "@" in value, "." in value,
        passes(kind, value) if kind in BASE else 0.0,
    ]
    return [1.0, *(float(kind == k) for k in KINDS), *map(float, look), *map(float, beside), *hashed]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic model of probabilities, by Newton steps, all but the first drawn to zero."""
    weights, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + pull * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class PiiModel:
    reliabilities: dict[str, Reliability]
    weights: np.ndarray | None

    def score(self, text: str, spans: list[Span]) -> np.ndarray:
        if self.weights is None or not spans:
            return np.zeros(len(spans))
        x = np.array([features(s[2], *around(text, s)) for s in spans])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))

    def spans(self, text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, bool, float]]:
        """start, end, kind, whether strict, and score of the spans of a text, in order."""
        found = candidates(text)
        strict = {s for s in strict_matches(text) if passes(s[2], text[s[0] : s[1]])} if found else set()
        scores = self.score(text, found)
        kept = [(*s, True, float(p)) for s, p in zip(found, scores, strict=True) if s in strict]
        taken = sorted((s[0], s[1]) for s in kept)
        starts = np.array([a for a, _ in taken], np.int64)
        reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, np.int64)
        end = 0
        for span, p in zip(found, scores, strict=True):
            if span in strict or p < threshold or span[0] < end:
                continue
            # The strict spans that start before this one's end must all end before its start.
            before = int(np.searchsorted(starts, span[1]))
            if before and reach[before - 1] > span[0]:
                continue
            kept.append((*span, False, float(p)))
            end = span[1]
        return sorted(kept, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def fit(docs: DataFrame, limit: int = MAX_SPANS) -> PiiModel:
    """The model of a corpus: reliabilities from all its candidates, the classifier from `limit`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for raw in batch.column(0).to_pylist():
            text = raw.decode("utf-8", "replace")
            for span in candidates(text):
                seen = around(text, span)
                rows.append((span[2], "".join("-0+"[v + 1] for v in votes_on(span[2], *seen)), *seen))
        names = ["kind", "votes", "value", "before", "after"]
        columns = zip(*rows, strict=True) if rows else ([] for _ in names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)

    voted = map_slices(as_bytes(docs), work, ", ".join(f"{c} string" for c in ("kind", "votes", "value", "before", "after")))
    voted = materialize(voted, "pii_candidates")
    # A row for each kind and vote pattern.
    patterns = voted.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    names = ("kind", "value", "before", "after", "votes")
    # Repeated candidates are one, and hashes are cut to some times the limit before they are put in
    # order, so that what all tasks together hand on has a bound, too.
    total = sum(r["n"] for r in patterns)
    wanted = min(_SHARES, -(-4 * limit * _SHARES // max(total, 1)))
    few = voted.where(F.pmod(F.xxhash64(*names), F.lit(_SHARES)) < wanted).select(*names).distinct()
    sample = few.orderBy(F.xxhash64(*names), *names).limit(limit).collect()
    for path in {f.rsplit("/", 1)[0] for f in voted.inputFiles()}:
        delete_path(docs.sparkSession, path)
    in_numbers = lambda rows: np.array([["-0+".index(c) - 1 for c in r["votes"]] for r in rows]).reshape(-1, len(LABELERS))
    reliabilities = {}
    for kind in KINDS:
        own = sorted((r for r in patterns if r["kind"] == kind), key=lambda r: r["votes"])
        if own:
            reliabilities[kind] = estimate(in_numbers(own), np.array([r["n"] for r in own], float))
    if not sample:
        return PiiModel(reliabilities, None)
    x = np.array([features(r["kind"], r["value"], r["before"], r["after"]) for r in sample])
    y = np.array([reliabilities[r["kind"]].probability(in_numbers([r]))[0] for r in sample])
    return PiiModel(reliabilities, logistic(x, y))


def find_spans(docs: DataFrame, model: PiiModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans (start, end, kind, strict, score; code points, end exclusive) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ("start", "end", "kind", "strict", "score")
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.float64())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.spans(t.decode("utf-8", "replace"), threshold) for t in batch.column(1).to_pylist()]
        flat = [s for spans in found for s in spans]
        columns = zip(*flat, strict=True) if flat else ([] for _ in fields)
        structs = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], fields)
        offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, structs)], ["doc_id", "spans"])

    slim = as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    schema = "doc_id long, spans array<struct<start int, end int, kind string, strict boolean, score double>>"
    return map_slices(slim, work, schema)


def redact(docs: DataFrame, model: PiiModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and text with each span replaced by its kind in brackets; of spans that overlap, one
    bracket for all, with the kind of the first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def cleaned(text: str) -> str:
        parts, at = [], 0
        for start, end, kind, _, _ in shared.value.spans(text, threshold):
            if start >= at:
                parts += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [cleaned(t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    slim = as_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    return map_slices(slim, work, "doc_id long, text string")


def span_report(docs: DataFrame, model: PiiModel) -> DataFrame:
    """doc_id, counts of the strict kinds, the digest of the strict spans, and all spans as text."""
    found = find_spans(docs, model)
    named = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    strict = F.filter("spans", lambda s: s["strict"])

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["strict"] & (s["kind"] == kind))
        return F.size(own).cast("long").alias(f"n_{kind}")

    digest = F.sha2(named(strict).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, BASE), digest, named("spans").alias("spans"))
