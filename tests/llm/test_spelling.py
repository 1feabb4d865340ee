"""Spelling variants against plain Python, and their edge cases."""

import random
import zlib
from collections import Counter

import pytest
import re

from votestream.llm.spelling import near_pairs, runs, spelling_variants, vocabulary, with_slips

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts):
    out = {}
    for w, n in counts.items():
        others = [(-counts[o], o) for o in counts if near(w, o)]
        most = min(others, default=None)
        form = most[1] if most and -most[0] >= 10 * n else None
        out[w] = (form, n, len(others), -most[0] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows, key=repr)


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def words(spark, counts):
    return spark.createDataFrame([(w, n, 1, 2, "x") for w, n in counts.items()],
                                 "word string, n bigint, key int, piece int, other string")


def some_words(seed, n=150):
    r = random.Random(seed)
    made = {}
    while len(made) < n:
        word = "".join(r.choice("abé𝄞") for _ in range(r.randrange(1, 9)))
        made[word] = r.choice([1, 2, 10, 20, 200, 2000])
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    counts = some_words(seed)
    assert found(spelling_variants(words(spark, counts))) == expected(counts)


def test_blocks_cut_into_tiles(spark):
    counts = some_words(3)
    table = words(spark, counts)
    wanted = sorted((a, b, counts[b]) for a in counts for b in counts if near(a, b))
    for pieces, tile in ((4, 3), (1, 40), (2, 5), (9, 10**6)):
        assert sorted(map(tuple, near_pairs(table, pieces, tile).collect())) == wanted


def test_odd_words(spark):
    long = "x" * 3_000
    counts = {long: 3, long + "y": 40, "Ab": 5, "ab": 60, "b": 1, "": 4, None: 7}
    good = {w: n for w, n in counts.items() if w}
    assert found(spelling_variants(words(spark, counts))) == expected(good)
    assert spelling_variants(words(spark, {})).count() == 0


def test_a_chain_of_forms(spark):
    counts = {"a" * k: 10 ** (k - 1) for k in range(1, 9)}
    rows = {r.word: r.root for r in spelling_variants(words(spark, counts)).collect()}
    assert set(rows.values()) == {"a" * 8}


def test_from_documents(spark, documents):
    r = random.Random(5)
    stems = ["Straßenbahn", "ÉTUDIANTS", "generation", "generations", "señorita", "kurz"]
    texts = [None, "", "12 ---", "x" * 20_000] + [" ".join(r.choice(stems) for _ in range(60)) for _ in range(60)]
    table = documents(*[(i, t, "en", "s") for i, t in enumerate(texts)], (None, "generation generation señorita", None, None))
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    counts = Counter()
    for i, t in [*enumerate(texts), (None, "generation generation señorita")]:
        for w in RUN.findall((t or "").translate(low)):
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert any(form for _, form, *_ in expected(counts))
    assert found(spelling_variants(vocabulary(with_slips(runs(table))))) == expected(counts)
