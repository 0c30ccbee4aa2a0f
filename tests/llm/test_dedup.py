import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from opinlake.llm import exact_dedup, line_dedup, simhash, suffix_dedup
from opinlake.llm.components import connected_components

BLANK = re.compile(r"[\x20\x09-\x0D]")
ALL = (1 << 64) - 1
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# -- exact


def exact_expected(corpus):
    groups = defaultdict(list)
    for doc_id, text in corpus:
        groups[BLANK.sub("", text or "")].append((len(text or ""), doc_id))
    expected = []
    for bare, members in groups.items():
        size, keep = min(members, key=lambda m: (-m[0], m[1] is None, m[1] or 0))
        digest = hashlib.sha256(bare.encode()).hexdigest()
        expected += [(i, keep, len(members), i == keep and n == size, digest) for n, i in members]
    return sorted(expected, key=repr)


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda c: F.length(c).cast("long") % 3])
def test_exact_dedup(docs, corpus, rows_of, hash_of):
    """Also with a hash that many chunks share: then identifiers need their ordinals."""
    assert rows_of(exact_dedup.find_repeats(docs, hash_of)) == exact_expected(corpus)


def test_exact_dedup_keeps_one_row_and_all_columns(docs, corpus, rows_of, no_docs):
    kept = exact_dedup.drop_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in rows_of(kept, "doc_id")), key=repr) == sorted(
        {(e[1], e[4]): e[1] for e in exact_expected(corpus)}.values(), key=repr
    )
    assert exact_dedup.drop_repeats(no_docs).count() == exact_dedup.find_repeats(no_docs).count() == 0


def test_chunks_follow_content(spark):
    """An insertion at the start leaves later chunks as they were."""
    rnd = random.Random(1)
    body = "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(60_000))
    frame = spark.createDataFrame([(1, body), (2, "xyz" + body)], "doc_id long, text string")
    first, second = (set(r["chunks"]) for r in exact_dedup._chunked(frame).orderBy("doc_id").collect())
    assert len(first & second) > 0.9 * len(first) > 10
    rows = exact_dedup._chunked(frame).collect()
    assert all(len(c) <= exact_dedup.CHUNK_MAX for r in rows for c in r["chunks"])


# -- lines


def lines_expected(corpus, min_docs=2):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(LOWER)

    holders = defaultdict(set)
    for doc_id, text in corpus:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 10:
                holders[key(line)].add(doc_id)
    expected = []
    for doc_id, text in corpus:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if doc_id is None or len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == doc_id
        ]
        expected.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return expected


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(docs, corpus, rows_of, min_docs):
    expected = lines_expected(corpus, min_docs)
    digests = [(*e[:3], hashlib.sha256(e[3].encode()).hexdigest()) for e in expected]
    assert rows_of(line_dedup.line_report(docs, min_docs=min_docs)) == sorted(digests, key=repr)
    texts = line_dedup.drop_repeated_lines(docs, min_docs=min_docs)
    assert texts.columns == docs.columns
    assert rows_of(texts, "doc_id", "text") == sorted(((e[0], e[3]) for e in expected), key=repr)


def test_line_dedup_of_nothing(no_docs):
    assert line_dedup.line_report(no_docs).count() == 0


# -- fingerprints


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(docs, corpus, rows_of, no_docs):
    prints = [(i, fingerprint(t)) for i, t in corpus]
    nodes = {f for _, f in prints}
    near = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & ALL).bit_count() <= 2]
    roots = roots_of(nodes, near)
    names = defaultdict(lambda: None)
    for i, f in prints:
        if i is not None:
            names[roots[f]] = min(i, names[roots[f]] or i)
    expected = sorted(((i, f"{f:016x}", names[roots[f]]) for i, f in prints), key=repr)
    assert rows_of(simhash.near_duplicates(docs)) == expected
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    own = [i for i, _, c in expected if i is None or i == c]
    assert [r[0] for r in rows_of(kept, "doc_id")] == sorted(own, key=repr)
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("limit, crowd", [(4, 100), (1000, 100), (4, 3)])
def test_links_whatever_the_bucket_limit(spark, limit, crowd):
    """Dense and sparse groups of fingerprints, through joins, neighbours and a mix of both."""
    rnd = random.Random(7)
    nodes = {rnd.getrandbits(64) for _ in range(60)}
    for base in list(nodes)[:12]:
        for _ in range(40 if base & 1 else 4):
            changed = base
            for _ in range(rnd.randrange(1, 5)):
                changed ^= 1 << rnd.randrange(64)
            nodes.add(changed)
    signed = {n - (1 << 64) if n >> 63 else n for n in nodes}
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ALL).bit_count() <= 2]
    frame = spark.createDataFrame([(n,) for n in signed], "fp long")
    found = simhash.links(frame, limit, crowd)
    pairs = [(r["a"], r["b"]) for r in found.collect()]
    if limit == 1000:
        assert sorted(map(tuple, map(sorted, pairs))) == sorted(near)
    assert all(((a ^ b) & ALL).bit_count() <= 2 for a, b in pairs)
    linked = connected_components(found)
    whole = {n: n for n in signed} | {r["node"]: r["root"] for r in linked.collect()}
    assert whole == roots_of(signed, near)


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100)] + [(500, k) for k in range(501, 600)] + [(7, 7), (1000, 999)]
    frame = spark.createDataFrame(edges, "a long, b long")
    nodes = {n for e in edges for n in e}
    found = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    assert found == roots_of(nodes, edges)
    assert connected_components(frame.limit(0)).count() == 0


# -- passages


def repeated_words(corpus):
    """(doc_id, word) of all words in windows of 50 that some other document has, too."""
    words = {i: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER)) for i, t in corpus if i is not None}
    holders = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    return {
        (i, p)
        for i, w in words.items()
        for k in range(len(w) - 49)
        if len(holders[tuple(w[k : k + 50])]) > 1
        for p in range(k, k + 50)
    }


def test_repeated_passages(docs, corpus, rows_of, no_docs):
    rows = rows_of(suffix_dedup.repeated_passages(docs))
    assert {(r[0], p) for r in rows for p in range(r[1], r[2])} == repeated_words(corpus)
    assert {r[0] for r in rows} == {1, 2, 3, 4, 8, 9}
    assert all(r[3] == r[2] - r[1] and r[4] != r[0] for r in rows)
    assert suffix_dedup.repeated_passages(no_docs).count() == 0


def test_passage_in_many_documents(spark):
    from tests.llm.conftest import prose

    passage = prose(99, 55)
    rows = [(k, f"{prose(1000 + k, k % 30)} {passage} {prose(2000 + k, k % 17)}") for k in range(120)]
    rows += [(k, prose(k, 80)) for k in range(500, 520)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = suffix_dedup.repeated_passages(frame).collect()
    assert {(r["doc_id"], p) for r in found for p in range(r["start_word"], r["end_word"])} == repeated_words(rows)
    assert {r["doc_id"] for r in found} == set(range(120))


def test_a_partner_that_is_no_nearest_neighbour(spark):
    """Two documents share what comes before a place; others share more of what follows it."""
    from tests.llm.conftest import prose

    words = prose(77, 90).split()
    rows = [(1, " ".join(words[:62])), (2, " ".join(words[:58]) + " " + prose(5, 30))]
    rows += [(10 + k, f"{prose(300 + k, 40)} {' '.join(words[30:78])} {prose(400 + k, 20)}") for k in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.repeated_passages(frame).collect()
    assert {(r["doc_id"], p) for r in found for p in range(r["start_word"], r["end_word"])} == repeated_words(rows)
    assert {r["doc_id"] for r in found} == {1, 2}
