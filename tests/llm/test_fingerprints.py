"""Fingerprints: entropies against plain Python, likeness of edited texts, edge cases."""

import hashlib
import random
from collections import Counter
from math import log2

import numpy as np
import pytest

from votestream.llm import fingerprints as fp

LONG = " ".join(f"word{i} of{i % 7}" for i in range(40_000))


@pytest.fixture(scope="module")
def ranks(spark, small):
    return fp.learn_ranks(spark.read.parquet(f"{small[0]}/documents.parquet"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_entropies(seed):
    r = random.Random(seed)
    data = bytes(r.choice([97, 98, 32, 255, r.randrange(256)]) for _ in range(300)) + b"a" * 50
    entropies = []
    for i in range(len(data) - fp.WINDOW + 1):
        counts = Counter(data[i : i + fp.WINDOW]).values()
        entropies.append(-sum(c / fp.WINDOW * log2(c / fp.WINDOW) for c in counts))
    classes = fp.entropy_classes(np.frombuffer(data, np.uint8))
    assert np.abs(classes - np.array(entropies) * fp.CLASSES / log2(fp.WINDOW)).max() <= 1.001


def test_class_counts(spark, documents):
    texts = ["ab" * 40, None, "", "short", "ab" * 40, "The quick brown fox jumps over the lazy dog again and again."]
    found = {r["class"]: r.n for r in fp.class_counts(documents(*texts)).collect()}
    wanted = Counter()
    for t in texts:
        wanted.update(fp.entropy_classes(np.frombuffer((t or "").encode(), np.uint8)).tolist())
    assert found == wanted


def test_digests_do_not_depend_on_the_texts_beside(small, ranks):
    texts = [t or "" for t in small[1].values()]
    together = [str(d) for d in fp.digests_of(texts, ranks)]
    assert together == [str(fp.digests_of([t], ranks)[0]) for t in texts]


def test_likeness(small, ranks):
    texts = [t for t in small[1].values() if t and len(t) > 400]
    own = fp.digests_of(texts, ranks)
    half = fp.digests_of([t[len(t) // 2 :] for t in texts], ranks)
    assert all(fp.likeness(d, d) == pytest.approx(1) for d in own)
    assert np.mean([fp.likeness(a, b) for a, b in zip(own, half)]) > 0.5
    for a, b in zip(own[:20], own[1:]):
        assert fp.likeness(a, b) == fp.likeness(b, a)
        assert fp.likeness(fp.Digest.parse(str(a)), b) == fp.likeness(a, b)
    nothing = fp.Digest.parse("")
    assert fp.likeness(nothing, nothing) == 1 and fp.likeness(nothing, own[0]) == 0


def brute(rows):
    """(doc_id, n_chars, digest of the edited text) of rows in order, the first following the last."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_whole_table(spark, small, ranks):
    sf_dir, docs = small
    found = fp.compared_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5), ranks).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == brute(docs.items())
    ids = sorted(docs)
    signed = {r.doc_id: r.fingerprint for r in fp.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks).collect()}
    for r in found:
        assert r.fingerprint == signed[r.doc_id] == str(fp.digests_of([docs[r.doc_id] or ""], ranks)[0])
        after = docs[ids[(ids.index(r.doc_id) + 1) % len(ids)]] or ""
        edit = fp.digests_of([fp.edited(docs[r.doc_id] or "", after)], ranks)[0]
        assert r.edited_fingerprint == str(edit)
        assert r.near_edited == fp.likeness(fp.Digest.parse(r.fingerprint), edit)
        assert r.near_next == fp.likeness(fp.Digest.parse(r.fingerprint), fp.Digest.parse(signed[ids[(ids.index(r.doc_id) + 1) % len(ids)]]))
    long = [r for r in found if r.n_chars >= 400]
    assert np.mean([r.near_edited for r in long]) > 0.65
    assert np.mean([r.near_next for r in long]) < 0.1


ODD = [(1, LONG), (2, ""), (2, None), (3, "é" * 500), (3, "tiny"), (3, "tiny"), (None, "nowhere to be"), (None, None), (9, "𝄞" * 9)]


@pytest.mark.parametrize("rows", [ODD, ODD[:1], ODD[1:3], ODD[6:8], [(5, "same")] * 40, []])
def test_odd_rows(spark, ranks, rows):
    schema = "doc_id bigint, text string, part int, guest string, own int, lang string"
    table = spark.createDataFrame([(*r, 1, "g", 2, None) for r in rows], schema).repartition(3)
    found = fp.compared_fingerprints(table, ranks).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == brute(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    texts = {i: t for i, t in rows}
    assert all(r.fingerprint == "" for r in found if not r.n_chars)
    assert fp.learn_ranks(table).shape == (fp.CLASSES + 1,) and len(texts) <= len(rows)
