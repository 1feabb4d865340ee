"""The parts the operators are made of, without Spark."""

import base64
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import brute
from votestream.llm import arrays, bpe, near_dedup, passages, suffix_dedup, toxicity
from votestream.llm.anchors import anchor_runs, window_minima
from votestream.llm.decontamination import Items, SuffixAutomaton
from votestream.llm.token_files import _encoder

TEXTS = st.lists(st.text("aB7é ß\n\t.,-\x0b ", max_size=30), max_size=5)


def blocks_of(texts):
    return arrays.utf8(pa.array(texts, pa.string()))


@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    data, offsets = blocks_of(texts)
    low = arrays.LOWER[data]
    for separates, pattern in ((arrays.IS_SPACE, brute.WORDS), (arrays.IS_SEPARATOR, brute.ITEM_WORDS)):
        starts, ends = arrays.words(low, offsets, separates)
        found = [bytes(low[a:b]).decode() for a, b in zip(starts, ends)]
        assert found == [w for t in texts for w in pattern.findall(brute.low(t))]


@given(TEXTS, st.integers(1, 4))
def test_shingle_sets_have_the_right_sizes_and_overlaps(texts, size):
    sets = arrays.shingle_sets(*blocks_of(texts), size)
    wanted = [brute.shingles(t, size) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in wanted]
    for a, x in zip(sets, wanted):
        for b, y in zip(sets, wanted):
            assert len(np.intersect1d(a, b)) == len(x & y)


@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 20))
def test_window_minima(values, width):
    if width <= len(values):
        found = window_minima(np.array(values, np.uint64), width)
        assert found.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_every_window_has_an_anchor_that_depends_on_its_bytes():
    rng = random.Random(1)
    shared = bytes(rng.choices(b"abc ", k=400))
    texts = [bytes(rng.choices(b"abc ", k=rng.randrange(500))) + shared + b"xyz" * rng.randrange(90)
             for _ in range(6)] + [b"", b"short", b"a" * 700]
    data, offsets = blocks_of([t.decode() for t in texts])
    first, last, anchor, key = anchor_runs(data, offsets, 200)
    seen, windows = {}, 0
    for a, b, p, k in zip(first, last, anchor, key):
        for s in range(a, b + 1):
            assert s <= p <= s + 160
            windows += 1
            assert seen.setdefault(bytes(data[s : s + 200]), (p - s, k)) == (p - s, k)
    assert windows == sum(max(0, len(t) - 199) for t in texts)


@given(st.lists(st.lists(st.integers(0, 9), max_size=25), max_size=4), st.integers(1, 6))
def test_compact_windows_are_those_of_the_tree(texts, passage):
    values = np.array([v for t in texts for v in t], np.uint64) << np.uint64(40)
    at = np.cumsum([0, *map(len, texts)])
    found = set(zip(*(x.tolist() for x in passages.compact_windows(values, at, passage))))
    wanted = set()
    for begin, text in zip(at, texts):
        for c, v in enumerate(text):
            l, r = c, c  # ties go to the left
            while l > 0 and text[l - 1] > v:
                l -= 1
            while r + 1 < len(text) and text[r + 1] >= v:
                r += 1
            if r - l + 1 >= passage:
                wanted.add((begin + l, begin + c, begin + r))
    assert found == wanted


@given(st.lists(st.lists(st.integers(0, 3), max_size=12), max_size=4), st.lists(st.integers(0, 4), max_size=30))
def test_automaton_tracks_the_longest_match(items, stream):
    automaton = SuffixAutomaton()
    for item in items:
        automaton.add(item)
    parts = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    state = matched = 0
    for i, symbol in enumerate(stream):
        state, matched = automaton.step(state, matched, symbol)
        ending = [n for n in range(i + 2) if n == 0 or tuple(stream[i + 1 - n : i + 1]) in parts]
        assert matched == max(ending)


def test_empty_benchmark_matches_nothing():
    items = Items([], 10)
    assert items.runs(np.arange(5, dtype=np.uint64), np.zeros(5, np.int64)) == []


def test_suffixes_are_sorted_and_repeats_verified():
    rng = random.Random(2)
    core = bytes(rng.choices(b"ab", k=40))
    parts = [bytes(rng.choices(b"ab", k=30)) + core + bytes(rng.choices(b"ab", k=30)) for _ in range(9)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    length = 20
    places = np.concatenate([np.arange(81) + 100 * i for i in range(9)])
    groups = np.repeat([0, 1, 2], 27 * 9)
    suffixes = suffix_dedup.Suffixes(data, places, length)
    order, segment = suffixes.sorted(groups)
    strings = [bytes(data[p : p + length]) for p in places]
    for s in np.unique(segment):
        own = [strings[i] for i in order[segment == s]]
        assert own == sorted(own)
    count = {}
    for g, s in zip(groups, strings):
        count[g, s] = count.get((g, s), 0) + 1
    assert suffixes.repeated(groups).tolist() == [count[g, s] > 1 for g, s in zip(groups, strings)]


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(3)
    for size, common in ((2000, 1800), (500, 250), (60, 55)):
        every = np.unique(rng.integers(0, 2**63, 2 * size, dtype=np.uint64))
        a = np.sort(every[:size])
        b = np.sort(np.concatenate([every[:common], every[size : 2 * size - common]]))
        x, y = near_dedup.registers([a, b])
        wanted = common / (2 * size - common)
        found = near_dedup.estimate((x == y).mean(), float(size), float(size))
        assert abs(found - wanted) < 0.2
    assert near_dedup.collision_rate(5.0, 5.0) < 2e-4
    tiny = near_dedup.registers([np.array([7], np.uint64), np.array([7], np.uint64)])
    assert (tiny[0] == tiny[1]).all() and len(set(tiny[0])) == 1


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_bands_miss_next_to_nothing(threshold):
    rows = near_dedup.band_rows(threshold)
    assert (1 - threshold**rows) ** (near_dedup.REGISTERS // rows) <= near_dedup.MISS
    assert rows >= 4


@pytest.fixture(scope="module")
def multi():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Bpe(path, public_tokenizers.PATTERN), known


AWKWARD = ["", " ", "  a", "a ", "a\n\nb", "a \n b", "x y z", "tab\t q", "it's 'll don't", "\x1c a \x1f b",
           "a​ b", "émeute ça 12 345!", "日本語 テスト", "<|endoftext|>", "퟿", "a" * 300,
           " ᠎ b", "one\ntwo three\n\nfour  five\r\nsix", "👩‍👩‍👧 ok", "word   wide"]


def test_ids_are_those_of_the_library(multi):
    own, known = multi
    for text in AWKWARD:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t  'sx.5é"), st.characters(codec="utf-8")), max_size=25))
def test_ids_of_any_text(multi, text):
    own, known = multi
    assert np.frombuffer(own.encode(text), "<u4").tolist() == known.encode_ordinary(text)


def test_pieces_of_the_tokenizers_library():
    encoder = _encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in AWKWARD:
        assert encoder.encode(text) == encoder.whole(text), repr(text)


def test_folding_and_exceptions():
    assert toxicity.folded("Ｌ0SER, іdi0t!​ d!rt") == " loser idiot dirt "
    lexicon = toxicity.Lexicon({" loser ": 3.0, " idio": 2.0, " idiot ": 4.0}, ("sore loser",))
    assert lexicon.weigh(toxicity.folded("a sore loser and an idiot")) == (4.0, 6)
    assert lexicon.weigh(toxicity.folded("loser")) == (3.0, 1)
    assert lexicon.score("idiot") > lexicon.score("idiot " + "fine " * 200) > lexicon.score("") == lexicon.score(None)
    assert 0 <= lexicon.score("idiot " * 1000) <= 1
    assert re.fullmatch(r" ", toxicity.folded("")) and toxicity.Lexicon({}).weigh(" ") == (0.0, 0)


def test_new_words_are_encoded_without_offsets():
    """Many words at once give the ids that the library gives each of them, after a space and after a line feed."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, many = Tokenizer.from_file(path), _encoder(path).many
    words = ["Ġ", "Ċ", "a\tb", "é", "\u6f22\u5b57", "don't", "x1", "...", "\U0001f600", "qzxv" * 9, "a\xa0b"]
    for before in " ", "\n":
        wanted = [tokenizer.encode(before + w, add_special_tokens=False).ids[before == "\n":] for w in words]
        assert [np.frombuffer(ids, "<i4").tolist() for ids in many(words, before)] == wanted


def test_what_a_task_has_learnt_is_forgotten():
    """A worker that waits for other tasks holds on to the words learnt first only."""
    learn = bpe.Bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    text = " ".join(f"word{i}\nline{i}" for i in range(500))
    ids = learn.encode(text)
    learn.encoder.forget(100)
    assert len(learn.encoder.spaced) == len(learn.encoder.bare) == 100
    assert learn.encode(text) == ids and learn.decode(ids) == text.encode()
