import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from opinlake.llm import bpe, token_files


@pytest.fixture(scope="module")
def codec():
    return bpe.BpeCodec(bpe.default_vocabulary())


def ids_of(codec, text):
    return codec.library.encode(text or "", add_special_tokens=False).ids


def test_every_plain_character_and_random_texts(codec):
    rnd = random.Random(3)
    alphabet = "abcdeé'tsrev1 ²½ΣςİJ̌\x1c\x85\xa0<|endoftext|>Ⅷ中😀_-\n\x00"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(50))) for _ in range(800)]
    texts += [f"{chr(k)} x{chr(k)}'y{chr(k)}s" for k in range(1, 0x250)]
    texts += ["", "a" * 300, "aaa" * 5, "thethe" * 40, "<|endoftext|>", "<|ENDOFTEXT|> B", "'Tis don't !'s ''s"]
    for text, ids in zip(texts, codec.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == ids_of(codec, text), text
        assert codec.decode(ids) == codec.library.decode(ids.tolist(), skip_special_tokens=False)


def test_pairs_are_compatible_exactly_when_merging_keeps_them(codec):
    rnd = random.Random(5)
    ends = np.flatnonzero(codec.ends)
    inner = np.flatnonzero(~codec.ends)[:20_000]
    a = np.array([rnd.choice(inner) for _ in range(3000)])
    b = np.array([rnd.choice(ends) for _ in range(3000)])
    fine = codec.table.compatible(a, b)
    words = [codec.names[x] + codec.names[y].removesuffix(codec.suffix) for x, y in zip(a, b, strict=True)]
    merged = [np.frombuffer(m, "<u4").tolist() for m in codec.merge(words)]
    assert [m == [x, y] for m, x, y in zip(merged, a.tolist(), b.tolist(), strict=True)] == fine.tolist()
    assert 0 < fine.sum() < len(fine)


def test_only_failing_words_are_merged(codec):
    assert 0 < codec.failed < codec.speculated


def test_cache_bound(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    texts = [b"one two three four", b"five six seven eight nine", b"one two"]
    for text in texts:
        assert codec.encode([text])[0].tolist() == ids_of(codec, text.decode())


def test_round_trip_of_documents(docs, corpus, codec, rows_of, no_docs):
    expected = []
    for doc_id, text in corpus:
        ids = ids_of(codec, text)
        decoded = codec.library.decode(ids, skip_special_tokens=False)
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), listed, hashlib.sha256(decoded.encode()).hexdigest()))
    assert rows_of(bpe.round_trip(docs)) == sorted(expected, key=repr)
    assert bpe.round_trip(no_docs).count() == 0


def test_encode_then_decode(docs, corpus, codec, rows_of):
    coded = bpe.encode_documents(docs)
    assert rows_of(coded) == sorted(((i, ids_of(codec, t)) for i, t in corpus), key=repr)
    texts = [(i, codec.library.decode(ids_of(codec, t), skip_special_tokens=False)) for i, t in corpus]
    assert rows_of(bpe.decode_documents(coded)) == sorted(texts, key=repr)


@pytest.mark.parametrize("ends", [[0], [5], [3, 3, 3], [1, 2, 900_000], list(range(0, 6000, 7)), [0, 0, 0, 1]])
def test_elias_fano(ends):
    coded = token_files.encode_borders(np.array(ends))
    borders = token_files.BlockBorders(len(ends), *coded)
    assert borders.ends().tolist() == ends
    assert [borders.end(i) for i in range(len(ends))] == ends
    assert [borders.start(i) for i in range(len(ends))] == [0, *ends[:-1]]
    with pytest.raises(IndexError):
        borders.end(len(ends))


def test_files_in_small_blocks(spark, docs, corpus, codec, tmp_path):
    target = str(tmp_path / "files")
    token_files.write_token_files(docs, target, block_ids=50)
    found = token_files.read_documents(spark, target).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    at = 0
    for row in found:
        assert row["start"] == at
        at += len(row["ids"])
    expected = Counter((i, (*ids_of(codec, t), 2)) for i, t in corpus)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == expected
    digests = token_files.document_digests(spark, target).collect()
    sums = {(r["doc_id"], r["start"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in found}
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in digests} == sums


def test_no_documents_no_rows(no_docs):
    assert token_files.token_file_report(no_docs).count() == 0
