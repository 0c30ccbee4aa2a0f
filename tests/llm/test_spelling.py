import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinlake.llm import spelling

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts, times=5):
    """All words against all words."""
    near = {w: [v for v in counts if v != w and is_near(v, w)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    stems = ["letter", "bettér", "aaaaaa", "balloon", "ÀÉÎõü÷×", "committee", "x" * 900]
    rows = []
    for k in range(700):
        words = []
        for _ in range(30):
            word = rnd.choice(stems[:6] if k % 9 else stems)
            for _ in range(rnd.choice([0, 0, 0, 0, 1, 1, 2])):
                at, c = rnd.randrange(len(word) + 1), rnd.choice("abté")
                word = rnd.choice([word[:at] + c + word[at:], word[:at] + word[at + 1 :], word[:at] + c + word[at + 1 :]])
            words.append(rnd.choice([word, word, word.upper(), word + "9", word.capitalize()]))
        rows.append((k, rnd.choice([" ", ", ", "\n", "-"]).join(words)))
    rows += [(3, rows[3][1]), (None, rows[4][1]), (None, None), (9, None), (10, ""), (11, "short words only")]
    return rows


def test_equals_all_words_against_all(spark, texts, rows_of):
    expected = plain_variants(plain_counts(texts))
    assert len(expected) > 300 and sum(r[3] is not None for r in expected) > 100
    assert any(r[5] not in (r[0], r[3]) for r in expected)  # a way of several forms
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    for name in ("word", "n", "path", "key", "part", "kind", "form", "root", "same"):
        frame = frame.withColumn(name, F.lit(1))
    assert rows_of(spelling.variants(frame)) == expected


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_numbers_do_not_depend_on_the_parts(spark, parts):
    """Nodes are one for each distinct beginning, in every division of the order."""
    words = sorted({"".join(p) for p in __import__("itertools").product("abc", repeat=4)} | {"a", "ab", "cc", "b" * 300})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
        found = {r["word"]: r["path"] for r in spelling.trie_paths(frame, F.col("word")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    nodes = {}
    for word, path in found.items():
        assert len(path) == len(word)
        for k, node in enumerate(path):
            assert nodes.setdefault(node, word[: k + 1]) == word[: k + 1]
    assert len(nodes) == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    assert [w for w, _ in sorted(found.items(), key=lambda x: x[1][-1])] == words


def test_nothing_to_find(spark, no_docs, rows_of):
    assert spelling.variants(no_docs).count() == 0
    alone = spark.createDataFrame([(None, "lonesome " * 5 + "single " * 4)], "doc_id long, text string")
    assert rows_of(spelling.variants(alone)) == [("lonesome", 5, 0, None, None, "lonesome")]


def test_ties_go_to_the_smaller_word(spark, rows_of):
    words = spark.createDataFrame([("planet", 5), ("planes", 50), ("planed", 50)], "word string, n long")
    found = {r[0]: r[1:] for r in rows_of(spelling.group_words(words))}
    assert found["planet"] == (5, 2, "planed", 50, "planed")
    assert found["planes"] == (50, 2, None, None, "planes")
