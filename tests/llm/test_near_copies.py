import random

import corpus_pipeline
import pytest

from opinlake.llm import near_copies
from tests.llm.conftest import prose


def shingle_set(text):
    words = (text or "").split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def first_of_each(rows, similarity=0.8):
    """The rows that stay, from all pairs of texts."""
    root = list(range(len(rows)))
    sets = [shingle_set(t) for _, t in rows]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(rows)):
        for a in range(b):
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k])
    return sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()), key=repr)


def changed(text, seed, n):
    rnd, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(1000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def planted():
    """Near copies on both sides of the limit, one large group, and reused or missing ids."""
    rows = [(k, prose(7000 + k, 100)) for k in range(60)]
    rows += [(100 + k, changed(rows[k][1], k, 1 + k % 5)) for k in range(50)]
    base = prose(8000, 120)
    rows += [(1000 + k, changed(base, 500 + k, 1 + k % 4)) for k in range(150)]
    # Equal texts without another near copy, and with some.
    rows += [(70, prose(9100, 80)), (71, prose(9100, 80)), (None, prose(9100, 80)), (72, rows[5][1]), (73, ""), (74, None)]
    rows += [(59, prose(9000, 60)), (100, prose(9001, 60)), (None, changed(rows[3][1], 1, 1)), (None, prose(9002, 60))]
    return rows


@pytest.mark.parametrize("block, size", [(near_copies.BLOCK, near_copies.BLOCK_SHINGLES), (16, 1000), (3, 300)])
def test_the_stage_drops_all_near_copies_and_no_other(spark, planted, rows_of, monkeypatch, block, size):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", size)
    docs = spark.createDataFrame(planted, "doc_id long, text string").repartition(4)
    kept = corpus_pipeline.remove_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert rows_of(kept) == first_of_each(planted)


def test_the_simhash_index_proposes_pairs_that_no_band_holds(spark):
    """With bands that nobody shares the fingerprints find the near copies, which are then decided exactly."""
    base = prose(8600, 3000)
    texts = [base, f"{base} end", f"{base} the end", prose(8601, 30), prose(8602, 300)]
    prints = [near_copies.simhash.fingerprint(t.encode(), near_copies.WORDS) for t in texts]
    assert all((a ^ b).bit_count() <= 2 for a in prints[:3] for b in prints[:3])
    nodes = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    F = near_copies.F
    own = near_copies._keys(nodes, near_copies.WORDS).withColumn("keys", F.array("node"))
    # The last two are given the fingerprint of the others: near in the index, unlike in words.
    same = prints[0] - (1 << 64) * (prints[0] >> 63)
    own = own.withColumn("fp", F.when(F.col("doc_id") > 2, F.lit(same)).otherwise(F.col("fp")))
    assert near_copies.links(nodes, own.select("node", "size", "keys")).isEmpty()
    roots = near_copies.connected_components(near_copies.links(nodes, near_copies._with_simhash(own)))
    node_of = {r["node"]: r["doc_id"] for r in own.collect()}
    found = [(node_of[r["node"]], r["root"]) for r in roots.collect()]
    assert sorted(doc for doc, _ in found) == [0, 1, 2] and len({root for _, root in found}) == 1


def test_near_copies_of_nothing(spark, docs, no_docs):
    assert near_copies.drop_near_copies(no_docs).count() == 0
    assert near_copies.drop_near_copies(docs).columns == docs.columns


def test_groups_within_a_bucket_and_what_lies_between_them(spark, rows_of, monkeypatch):
    """One bucket of three families at less than 0.8 from each other, two joined by a text between,
    and of texts that are like none."""
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    words = prose(8800, 100).split()

    def form(k):  # k words replaced at the end: near forms differ by few
        return words[: len(words) - k] + [f"x{n}" for n in range(k)]

    rows, number = [], 0
    for k, copies in ((0, 9), (5, 1), (10, 9), (60, 9)):
        for c in range(copies):
            rows.append((number, " ".join([*form(k), f"end{c}"])))
            number += 1
    nodes = spark.createDataFrame(rows, "doc_id long, text string")
    # All texts in one bucket, whatever their smallest hashes.
    own = near_copies._keys(nodes, 5).select("node", "size", near_copies.F.array(near_copies.F.lit(1).cast("long")).alias("keys"))
    roots = near_copies.connected_components(near_copies.links(nodes, own))
    known = {r["node"]: r["root"] for r in roots.collect()}
    node_of = {r["doc_id"]: r["node"] for r in near_copies._texts(nodes).collect()}
    groups = {}
    for k, text in rows:
        groups.setdefault(known.get(node_of[k], node_of[k]), []).append((k, text))
    assert rows_of(spark.createDataFrame([min(g) for g in groups.values()], nodes.schema)) == first_of_each(rows)
    assert sorted(map(len, groups.values())) == [9, 19]
