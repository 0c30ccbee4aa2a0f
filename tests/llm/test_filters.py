import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from opinlake.llm import decontaminate, license_scan, quality_rules, toxicity
from opinlake.llm.license_rules import CONFIDENCE, EXPRESSION, rules
from opinlake.llm.text_stats import STATS, TOXIC_STATS, measure
from opinlake.llm.trees import boost, isotonic, lasso_logistic
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


# -- decontamination

ITEMS = [
    (1, " ".join(prose(2, 60).split()[5:40])),
    (2, "THE, river"),
    (3, None),
    (4, "..."),
    (10, " ".join(prose(1, 6000).split()[3000:3012])),
    (10, " ".join(prose(1, 6000).split()[3000:3012])),
    (None, " ".join(prose(1, 6000).split()[10:25])),
    (5, prose(12345, 30)),
]


def contamination_expected(corpus):
    windows = {}
    for item_id, text in ITEMS:
        own = words_of(text)
        for k in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[k : k + 10]), set()).add(item_id)
    expected = []
    for doc_id, text in corpus:
        own, hit, items = words_of(text), set(), set()
        for window, holders in windows.items():
            for k in range(len(own) - len(window) + 1):
                if tuple(own[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    items |= holders - {None}
        names = ",".join(sorted(map(str, items)))
        digest = hashlib.sha256(names.encode()).hexdigest()
        expected.append((doc_id, len(own), len(hit), len(items), digest, bool(hit)))
    return sorted(expected, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_contamination(docs, corpus, items, rows_of, no_docs):
    expected = contamination_expected(corpus)
    assert rows_of(decontaminate.contamination(docs, items)) == expected
    assert sum(e[5] for e in expected) >= 4
    assert decontaminate.contamination(no_docs, items).count() == 0
    clean = decontaminate.contamination(docs, items.limit(0))
    assert clean.where("contaminated OR n_hit > 0").count() == 0 and clean.count() == len(corpus)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    bad = {e[0] for e in expected if e[5]} - {None}
    assert [r[0] for r in rows_of(kept, "doc_id")] == sorted((i for i, _ in corpus if i not in bad), key=repr)


def test_many_slices_give_the_same(docs, items, corpus, rows_of):
    found = decontaminate.find_matches(docs, items, slice_words=100)
    whole = decontaminate.find_matches(docs, items)
    assert rows_of(found, "doc_id", "n_words", "starts", "stops", "items") == rows_of(
        whole, "doc_id", "n_words", "starts", "stops", "items"
    )


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x a b q c y"), (2, "a b c"), (3, "a b q q q c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    near = {r["doc_id"]: r["items"] for r in decontaminate.find_matches(docs, items, slack=1).collect()}
    assert near == {1: [7], 2: [7], 3: []}
    exact = {r["doc_id"]: r["items"] for r in decontaminate.find_matches(docs, items).collect()}
    assert exact == {1: [], 2: [7], 3: []}


def test_a_segment_is_held_alone(spark, monkeypatch):
    """A file of the index has a row group for each segment, and a task gets one segment at a time."""
    texts = [(k, f"word{k} other " * 350_000) for k in range(3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    index = decontaminate.build_index(docs)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert [f.num_row_groups for f in files] == [f.num_rows for f in files] == [3]
    held = spark.sparkContext.accumulator(0)
    whole = decontaminate._search_segment

    def counted(row, *rest):
        held.add(int(row.column(3).offset == 0))  # not a slice of a larger batch
        return whole(row, *rest)

    monkeypatch.setattr(decontaminate, "_search_segment", counted)
    tests = decontaminate.cut_windows([(1, b"word1 other word1")])
    found = {r["doc_id"]: r["items"] for r in decontaminate.search(index, tests).collect()}
    assert found == {0: [], 1: [1], 2: []} and held.value == 3


# -- licenses

NOTICES = [
    "Licensed under the\n# Apache License, Version 2.0 and CC-BY 4.0. cc by CC by 😀 all rights, reserved; ALL  RIGHTS\tRESERVED",
    "SPDX-License-Identifier: GPL-2.0-or-later\nGNU General Public License version 3",
    "a😀 mit license mit license the MIT License",
    "GNU General Public License, version 2 general public license",
    "x " * 3000 + "mit license " * 200,
]


def scan_expected(text):
    text = text or ""
    own, places, base = words_of(text), [], set()
    for phrase, label in license_scan.BASE:
        parts = phrase.split()
        found = [k for k in range(len(own) - len(parts) + 1) if own[k : k + len(parts)] == parts]
        places += found
        base |= {label} if found else set()
    lines = [(m.start(), m.group()) for m in re.finditer(EXPRESSION, text, re.A)]
    hits = [
        (at + m.start(), -at - m.end(), r.tier, r.order, r.label, CONFIDENCE[r.kind])
        for r in rules()
        for at, part in (lines if r.kind == "tag" else [(0, text)])
        for m in re.finditer(r.pattern, part, re.A)
    ]
    hits.sort()
    kept = [h for k, h in enumerate(hits) if not any(e[1] <= h[1] and e[2] <= h[2] for e in hits[:k])]
    score = max([h[5] for h in kept] + ([license_scan.BASE_CONFIDENCE] if places else []) + [0.0])
    first, last = (min(places), max(places)) if places else (None, None)
    labels = ",".join(sorted({h[4] for h in kept} | base))
    return len(own), len(places), first, last, ",".join(sorted(base)), labels, score


def example(pattern, rnd):
    """A text that the pattern matches, chosen at random."""

    def of(items):
        return "".join(one(kind, value) for kind, value in items)

    def one(kind, value):
        name = str(kind)
        if name == "LITERAL":
            return chr(value)
        if name == "ANY":
            return "x"
        if name == "IN":
            kind, value = rnd.choice(value)
            if str(kind) == "CATEGORY":
                return {"CATEGORY_SPACE": " ", "CATEGORY_DIGIT": "7"}[str(value)]
            return chr(value if str(kind) == "LITERAL" else rnd.randint(*value))
        if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = value
            return "".join(of(inner) for _ in range(rnd.randint(low, min(high, low + 2))))
        if name == "SUBPATTERN":
            return of(value[-1])
        if name == "BRANCH":
            return of(rnd.choice(value[1]))
        return ""  # what is asserted around a match

    return of(re._parser.parse(pattern, re.A))


def test_no_match_of_a_rule_is_lost_to_keyword_or_gate(spark):
    """Random texts of every rule: gated scanning finds what ungated scanning finds."""
    rnd = random.Random(11)
    made = [example(r.pattern, rnd) for r in rules() for _ in range(6)]
    made = [f"SPDX-License-Identifier: {t}" if t.startswith(("AND", "OR")) else t for t in made]
    made = [rnd.choice([str, str.upper, str.title])(t) for t in made]
    texts = list(enumerate(made))
    found = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    wrong = [(t, found[i], scan_expected(t)) for i, t in texts if found[i] != scan_expected(t)]
    assert not wrong, wrong[:3]
    assert all(found[i][5] for i, _ in texts)


def test_license_scan(spark, docs, corpus, rows_of, no_docs):
    patterns = [" ".join(r.pattern.replace("\\", "").split()) for r in rules()]
    texts = list(corpus) + list(enumerate(NOTICES + patterns, 100))
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(texts[len(corpus) :], "doc_id long, text string"))
    expected = sorted(((i, *scan_expected(t)) for i, t in texts), key=repr)
    assert rows_of(license_scan.scan(frame)) == expected
    assert license_scan.scan(no_docs).count() == 0


MIT_GRANT = "Permission is hereby granted, free of charge, to any person\n{0}obtaining a copy of this software"


@pytest.mark.parametrize(
    "text, labels",
    [
        (MIT_GRANT.format(" " * 14 + "* "), "mit"),
        (MIT_GRANT.format("%% "), "mit"),
        (MIT_GRANT.format("\n" * 500 + '"! '), "mit"),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2.0,mit"),
        ("SPDX-License-Identifier: MIT OR Apache-2.0\nOR ISC", "apache-2.0,mit"),
        ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 AND (ISC or MIT-0).", "gpl-2.0,isc,mit-0"),
        ("x😀 spdx-license-identifier:\tbsd-3-clause\rSPDX-License-Identifier: Zlib and X11", "bsd-3-clause,x11,zlib"),
        ("SPDX-License-Identifier: NOASSERTION", ""),
    ],
)
def test_wide_gaps_and_whole_expressions(spark, text, labels):
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert found["labels"] == labels
    assert tuple(found)[1:] == scan_expected(text)


def test_rules_are_many_and_base_phrases_have_keywords():
    assert len(rules()) > 200 and len({r.label for r in rules()}) > 80
    for (phrase, _), keyword in zip(license_scan.BASE, license_scan.BASE_KEYWORDS, strict=True):
        assert keyword in re.findall(license_scan.keyword_pattern(), phrase, re.A)


# -- classifiers


def labelled_corpus(spark, n=600):
    rows, labels = [], []
    for k in range(n):
        toxic, poor = k % 5 == 0, k % 7 == 0
        text = prose(k, 40)
        if toxic:
            text += f" you are a {'gronkel' if k % 2 else 'stupid'} {'gronkelin'} {prose(k, 3)}"
        if poor:
            text = " | ".join(w.upper() + "!!" for w in text.split())
        rows.append((k, text))
        labels.append((k, int(not poor), int(toxic)))
    rows += [(n, None), (n + 1, ""), (None, "nobody"), (0, rows[0][1])]
    labels += [(n, None, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality_rules, "quality")])
def test_classifiers_on_held_out_rows(spark, module, label):
    docs, labels = labelled_corpus(spark)
    model = module.fit(docs, labels)
    rows = module.score_documents(docs, model).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in range(602) if zlib.crc32(str(k).encode()) % 3 == 1}
    known = [r for r in held if truth.get(r["doc_id"]) is not None]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in known]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("module, score", [(toxicity, 0.0), (quality_rules, 1.0)])
def test_without_labels(spark, docs, corpus, module, score):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = module.score_documents(docs, module.fit(docs, labels)).collect()
    assert len(scored) == len(corpus)
    assert all(abs(r["score"] - score) < 0.01 for r in scored)


def test_rule_columns_equal_their_arrays(spark):
    docs, labels = labelled_corpus(spark, 300)
    model = quality_rules.fit(docs, labels)
    assert model.rules and all(str(r) for r in model.rules)
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect() if r["doc_id"] is not None]
    arrays = model.scores(measure([t for _, t in texts]))
    scored = quality_rules.score_documents(docs, model).where("doc_id IS NOT NULL").collect()
    assert sorted((r["doc_id"], round(r["score"], 9)) for r in scored) == sorted(
        (i, round(s, 9)) for (i, _), s in zip(texts, arrays.tolist(), strict=True)
    )


def test_texts_are_scored_in_bounded_memory():
    """Whole documents of 3 MB together: the arrays behind a score do not grow with the batch."""
    texts = [prose(k, 400).encode() for k in range(1500)] + [b"", prose(7, 2000).encode()]
    lexicon = toxicity.Lexicon(toxicity.INSULTS, frozenset())
    x = measure(texts[:200], lexicon)
    trees = boost(x, (np.arange(len(x)) % 3 == 0).astype(float))
    model = toxicity.ToxicityModel(lexicon, trees, (np.array([-9.0, 9.0]), np.array([0.0, 1.0])))
    tracemalloc.start()
    scores = model.score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * 2**20
    one_by_one = [model.score([text])[0] for text in texts[::50]]
    assert np.allclose(scores[::50], one_by_one, rtol=0, atol=1e-12)
    assert len(scores) == len(texts) and len(model.score([])) == 0


def test_drop_toxic_keeps_columns_and_clean_rows(spark):
    docs, labels = labelled_corpus(spark)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and sum(i is not None and i < 600 and i % 5 == 0 for i in ids) < 12
    assert len([i for i in ids if i is not None and i % 5]) >= 470


def test_measure_of_disguised_and_addressed_insults():
    names = (*STATS, *TOXIC_STATS)
    rows = measure([b"you are an idiot", b"such an 1d10t", b"i d i o t", b"calm words", b""], toxicity.Lexicon(toxicity.INSULTS, frozenset()))
    column = dict(zip(names, rows.T, strict=True))
    assert (column["addressed_share"] > 0).tolist() == [True, False, False, False, False]
    assert (column["obfuscated_share"] > 0).tolist() == [False, True, True, False, False]
    assert np.isfinite(rows).all()
    assert measure([]).shape == (0, len(STATS))


def test_small_models():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, 4))
    y = (x[:, 0] + (x[:, 1] > 0) > 0.5).astype(float)
    model = boost(x, y)
    assert ((model.margin(x) > 0) == y).mean() > 0.95
    points, values = isotonic(model.margin(x), y)
    assert (np.diff(values) >= 0).all() and (np.diff(points) >= 0).all()
    bias, weights = lasso_logistic(np.column_stack([x[:, 0] > 0, x[:, 3] > 0]).astype(float), (x[:, 0] > 0).astype(float), 0.01)
    assert abs(weights[0]) > 1 and weights[1] == 0 and np.isfinite(bias)
