import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinlake.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_base(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p[-4:]) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def plain_report(rows):
    out = []
    for doc_id, text in rows:
        base = plain_base(text)
        counts = [sum(b.startswith(f"{k}:") for b in base) for k in PLAIN]
        out.append((doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest()))
    return sorted(out, key=repr)


def card(rnd):
    body = "".join(rnd.choice("0123456789") for _ in range(15))
    return next(body + d for d in "0123456789" if plain_luhn(body + d))


def strict_only(text):
    return [f"{k}:{a}:{b}" for a, b, k in pii.in_order([s for s in pii.strict_matches(text) if pii.passes(s[2], text[s[0] : s[1]])])]


@pytest.mark.parametrize("letters", ["a@.-_ b", "01.2", "0 -1", "+1 ().-9x", "a1@.+ -(_%é😀", "@a.", "+0123456789 -."])
def test_strict_spans_are_those_of_the_plain_patterns(letters):
    rnd = random.Random(letters)
    for _ in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(40)))
        assert strict_only(text) == plain_base(text), text


def test_strict_spans_of_planted_data():
    rnd = random.Random(1)
    for _ in range(300):
        number = card(rnd)
        parts = [
            f"a.b%c{rnd.randrange(99)}@mail{rnd.randrange(9)}.example.com_x@y.z", f"{rnd.randrange(300)}.0.{rnd.randrange(300)}.00255.7",
            " ".join(number[k : k + 4] for k in range(0, 16, 4)), number, number + "0 1", f"+{rnd.randrange(10**9, 10**12)} (0) ",
            "x" * 50, "😀 é", "1" * 5000 + "." + "2.3.4",
        ]
        rnd.shuffle(parts)
        text = rnd.choice([" ", ", ", "", "\n"]).join(parts)
        assert strict_only(text) == plain_base(text)


@pytest.mark.parametrize("text", ["a" * 400_000, "a." * 200_000 + "@", "1" * 400_000, "1 " * 200_000, "+1" + " " * 400_000, "1.2." * 100_000, "+1 " * 130_000, "a-" * 200_000, "@a" * 200_000])
def test_very_long_runs_take_linear_time(text):
    import time

    began = time.perf_counter()
    pii.PiiModel({}, None).spans(text)
    assert time.perf_counter() - began < 20


def test_reliabilities_are_found():
    """Votes drawn from known rates: better labelers are told from worse, and classes from votes."""
    rnd = np.random.default_rng(2)
    truth = rnd.random(20000) < 0.3
    right = np.array([0.95, 0.9, 0.6, 0.85, 0.75, 0.9, 0.55, 0.8])
    casts = np.array([1.0, 0.5, 0.9, 0.7, 0.8, 0.6, 1.0, 0.9])
    agrees = rnd.random((20000, 8)) < right
    votes = np.where(agrees == truth[:, None], 1, -1) * (rnd.random((20000, 8)) < casts)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = pii.estimate(patterns, counts.astype(float))
    assert abs(model.prior - 0.3) < 0.03
    true_rate = model.rates[:, 1, 2] / (model.rates[:, 1, 2] + model.rates[:, 1, 0])
    assert np.abs(true_rate - right).max() < 0.04
    assert ((model.probability(votes) > 0.5) == truth).mean() > 0.97


def planted(seed, n):
    """(text, what a person would mark) with true and false candidates of the wider kinds."""
    rnd = random.Random(seed)
    words = "the river of stone and light over paper garden".split()
    rows = []
    for k in range(n):
        before = " ".join(rnd.choice(words) for _ in range(rnd.randrange(5, 40)))
        d = lambda m: "".join(rnd.choice("0123456789") for _ in range(m))
        hexes = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
        kind, lead, value, good = rnd.choice([
            ("phone", rnd.choice(["phone", "tel:", "call me:"]), f"({d(3)}) 555-{d(4)}", True),
            ("email", rnd.choice(["mail", "contact"]), f"jo.{rnd.choice(words)}{d(2)} [at] example [dot] com", True),
            ("secret", rnd.choice(["token =", "api key:", "password"]), hexes, True),
            ("ssn", "social security", f"{rnd.randrange(100, 600)}-{rnd.randrange(10, 99)}-{rnd.randrange(1000, 9999)}", True),
            ("phone", rnd.choice(["invoice", "order", "part"]), f"{d(2)}-{d(3)}-{d(3)}", False),
            ("ssn", rnd.choice(["item", "part"]), f"000-{d(2)}-{d(4)}", False),
            ("secret", "commit", "0000000000000000000000" + "0" * rnd.randrange(9), False),
            ("email", "we meet at", "noon", False),
        ])
        rows.append((f"{before} {lead} {value} {rnd.choice(words)}", (len(before) + len(lead) + 2, len(value), kind) if good else None))
    return rows


def test_the_method_adds_what_it_should(spark):
    known = planted(1, 1500)
    model = pii.fit(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(known)], "doc_id long, text string"))
    right = wrong = missed = 0
    for text, mark in planted(2, 800):
        added = [(a, b - a, k) for a, b, k, strict, _ in model.spans(text) if not strict]
        right += mark in added
        missed += mark is not None and mark not in added
        wrong += len([a for a in added if a != mark])
    assert right > 300 and missed <= 0.05 * (right + missed) and wrong <= 0.05 * right
    # As many of that kind were planted true as false.
    assert abs(model.reliabilities["ssn"].prior - 0.5) < 0.1


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    number = card(rnd)
    rows = [(k, t) for k, (t, _) in enumerate(planted(3, 200))]
    rows += [(1000 + k, f"mail x{k}@a{k}.example.org or +1 ({200 + k}) 555-0{100 + k} from 10.0.{k}.1, {number}") for k in range(40)]
    rows += [(3005, f"é😀 {number} q@w.de")] * 2 + [(None, "z@y.com"), (None, None), (3007, None), (3008, "")]
    rows += [(3009, ("plain words " * 40_000) + "a@b.cd"), (2000, "999.1.1.1 and +12 and 1234567890123")]
    return rows


def test_report(spark, rows, rows_of):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("spans", "kind", "votes", "value", "n_email", "start"):
        frame = frame.withColumn(name, F.lit(1))
    model = pii.fit(frame)
    found = pii.span_report(frame, model)
    assert found.columns == ["doc_id", *(f"n_{k}" for k in PLAIN), "base_sha256", "spans"]
    assert rows_of(found.drop("spans")) == plain_report(rows)
    texts = {i: t or "" for i, t in rows if i is not None}
    for row in found.where("doc_id IS NOT NULL").collect():
        own = [s.split(":") for s in row["spans"].split(",") if s]
        assert own == sorted(own, key=lambda s: (int(s[1]), pii.KINDS.index(s[0])))
        assert set(plain_base(texts[row["doc_id"]])) <= set(row["spans"].split(","))
    clean = {r["doc_id"]: r["text"] for r in pii.redact(frame, model).collect()}
    assert clean[3005].startswith("é😀 [card] [email]") and clean[3008] == "" and "@" not in clean[3009]


def test_nothing_to_learn_from(spark, no_docs):
    model = pii.fit(no_docs)
    assert model.weights is None and pii.span_report(no_docs, model).count() == 0
    clean = spark.createDataFrame([(1, "no such data"), (2, None)], "doc_id long, text string")
    assert [r["spans"] for r in pii.span_report(clean, pii.fit(clean)).collect()] == ["", ""]
    assert pii.PiiModel({}, None).spans("mail a@b.com")[0][:4] == (5, 12, "email", True)
