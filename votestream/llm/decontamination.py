"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' words are numbered, and one suffix automaton is built over all items. A
document is streamed through it word by word, which tells at every word the length of
the longest match with any item that ends there. Words in a match of ``window`` words
or more are hit, and so are those of a shorter item that occurs as a whole.

Nearly every word of a document ends a match of no more than one word. Those are found
without the automaton: two neighbouring words are both hit only if they are neighbours
in an item too. So the pairs are looked up in bulk, and only runs of known pairs are
streamed. (If an item has a single word, runs of known words are.)

The items are dealt out into blocks of at most ``BLOCK_WORDS`` words, so what is
broadcast has a bound whatever the size of the benchmark. Documents are read once for
each block. Documents are not shuffled unless there are several blocks.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..operators import materialise
from .arrays import (IS_SEPARATOR, LOWER, blocks, bounds, mixed, ranges, texts_of, utf8,
                     word_hashes, words)
from .shipping import in_arrow, ship

WINDOW = 10
BLOCK_WORDS = 500_000
#: ``decontaminated`` drops a document if more than this share of its words is hit.
MAX_COVERAGE = 0.5

_U = np.uint64


class SuffixAutomaton:
    """Of sequences of numbers. ``step`` follows one more number of a stream."""

    def __init__(self):
        self.length, self.link, self.next = [0], [-1], [{}]

    def add(self, sequence) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, symbol, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            known = self.next[at][symbol]
            fits = self.length[known] == self.length[at] + 1
            self.link[new] = known if fits else self._split(at, symbol, known)
        return new

    def _state(self, length: int, edges: dict) -> int:
        self.length.append(length)
        self.link.append(0)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, at: int, symbol: int, known: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[known]))
        self.link[copy] = self.link[known]
        self.link[known] = copy
        while at >= 0 and self.next[at].get(symbol) == known:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, matched: int, symbol: int) -> tuple[int, int]:
        while state and symbol not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if symbol in self.next[state]:
            return self.next[state][symbol], matched + 1
        return 0, 0


class Items:
    """One block of test items: their automaton, and which window belongs to which item."""

    def __init__(self, rows, window: int):
        self.window = window
        ids = [item_id for item_id, _ in rows]
        data, offsets = utf8(pa.array([text for _, text in rows], pa.string()))
        low = LOWER[data]
        starts, ends = words(low, offsets, IS_SEPARATOR)
        hashes = word_hashes(low, starts, ends)
        at = bounds(starts, offsets)
        self.known, numbers = np.unique(hashes, return_inverse=True)
        self.automaton = SuffixAutomaton()
        self.owners: dict[tuple, set] = defaultdict(set)
        pairs, self.short = [], set()
        for i, (begin, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            item = numbers[begin:end].tolist()
            if not item:
                continue
            self.automaton.add(item)
            size = min(window, len(item))
            if size < window:
                self.short.add(size)
            for k in range(len(item) - size + 1):
                self.owners[tuple(item[k : k + size])].add(ids[i])
            pairs.append(_pairs(hashes[begin:end]))
        self.least = min([window, *self.short])
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, _U)

    def runs(self, hashes: np.ndarray, texts: np.ndarray):
        """Runs of words of one text that could hold a window: first word, end."""
        if not len(self.known) or not len(hashes):
            return []
        if self.least == 1:
            possible = _within(self.known, hashes)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], possible.view(np.int8), [0]])))
            pieces = zip(edge[::2].tolist(), edge[1::2].tolist())
            return [part for a, b in pieces for part in _split_at_texts(a, b, texts)]
        possible = _within(self.pairs, _pairs(hashes)) & (texts[1:] == texts[:-1])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], possible.view(np.int8), [0]])))
        runs = zip(edge[::2].tolist(), (edge[1::2] + 1).tolist())
        return [(a, b) for a, b in runs if b - a >= self.least]

    def matches(self, numbers: list[int]):
        """Hit ranges of a run of numbered words, and the items whose windows occur."""
        step, state, matched = self.automaton.step, 0, 0
        hit, found = [], set()
        for i, number in enumerate(numbers):
            state, matched = step(state, matched, number)
            if matched >= self.window:
                hit.append((i + 1 - matched, i + 1))
                found |= self.owners[tuple(numbers[i + 1 - self.window : i + 1])]
            for size in self.short:
                if matched >= size:
                    owners = self.owners.get(tuple(numbers[i + 1 - size : i + 1]))
                    if owners:
                        hit.append((i + 1 - size, i + 1))
                        found |= owners
        return hit, found


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mixed(mixed(hashes[:-1]) + hashes[1:])


def _within(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


def _split_at_texts(begin: int, end: int, texts: np.ndarray):
    cuts = [begin, *(np.flatnonzero(np.diff(texts[begin:end])) + 1 + begin).tolist(), end]
    return list(zip(cuts[:-1], cuts[1:]))


def _scan(items: Items, data, offsets):
    """Per text: number of words, its hit words as ranges of bytes and words, the items."""
    low = LOWER[data]
    starts, ends = words(low, offsets, IS_SEPARATOR)
    hashes = word_hashes(low, starts, ends)
    at = bounds(starts, offsets)
    owner = texts_of(starts, offsets)
    hits, found = defaultdict(list), defaultdict(set)
    for begin, end in items.runs(hashes, owner):
        numbers = np.searchsorted(items.known, hashes[begin:end]).tolist()
        hit, names = items.matches(numbers)
        if hit:
            text = int(owner[begin])
            hits[text] += [(begin + a, begin + b) for a, b in hit]
            found[text] |= names
    for text in range(len(offsets) - 1):
        spans = []
        if text in hits:
            first, last = np.array(sorted(hits[text])).T
            first, last = ranges(first, last)
            spans = [(int(a - at[text]), int(b - at[text]),
                      int(starts[a] - offsets[text]), int(ends[b - 1] - offsets[text]))
                     for a, b in zip(first, last)]
        yield int(at[text + 1] - at[text]), spans, found.get(text, ())


_ADDED = ("n_words", "hits", "items")
_HIT = T.StructType([T.StructField(name, T.LongType())
                     for name in ("first_word", "end_word", "first_byte", "end_byte")])
_HITS_ARROW = pa.list_(to_arrow_type(_HIT))


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The items as lists of (item_id, text), each with at most ``block_words`` words.

    A word and what parts it from the next have two bytes at least, so bytes bound the
    number of words. A single item larger than that is a block alone. The driver holds
    one block and one partition of the benchmark at a time.
    """
    size = F.octet_length("text")
    rows = benchmark.where("text is not null").select("item_id", "text", size.alias("size"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        if block and held + row.size > 2 * block_words:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += row.size
    yield block


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``documents`` with ``n_words``, ``hits`` (ranges of words and bytes) and ``items``.

    Further columns pass through; columns of these three names are replaced. A NULL text
    has no words, nor has an empty one. Items with a NULL text or without words never
    occur; a NULL item id is listed as NULL. Each of several equal items is listed, and
    equal documents are judged alike. With an empty benchmark nothing is hit.
    """
    rows = documents.drop("n_words", "hits", "items")
    item_type = benchmark.schema["item_id"].dataType
    result = None
    for own in item_blocks(benchmark, block_words):
        if result is not None:  # each block adds to what the blocks before have found
            rows = materialise(result)
        result = _judged(rows, Items(own, window), item_type)
    return result


def _judged(rows: DataFrame, items: "Items", item_type) -> DataFrame:
    columns = [c for c in rows.columns if c not in _ADDED]
    going_on = len(columns) < len(rows.columns)
    text_at = rows.columns.index("text")
    kept_at = [rows.columns.index(c) for c in columns]
    kind = to_arrow_type(item_type)
    fields = [f for f in rows.schema.fields if f.name not in _ADDED]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()),
                           T.StructField("hits", T.ArrayType(_HIT)),
                           T.StructField("items", T.ArrayType(item_type))])
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def scan(batches):
        own = shared.value
        for batch in batches:
            counts, hits, names = [], [], []
            for _, _, data, offsets in blocks(*utf8(batch.column(text_at).fill_null(""))):
                for count, spans, found in _scan(own, data, offsets):
                    counts.append(count)
                    hits.append(spans)
                    names.append(found)
            if going_on:
                old_hits = batch.column(rows_columns.index("hits")).to_pylist()
                old_names = batch.column(rows_columns.index("items")).to_pylist()
                hits = [_united(a, [tuple(h.values()) for h in b]) for a, b in zip(hits, old_hits)]
                names = [set(a) | set(b) for a, b in zip(names, old_names)]
            names = [sorted(x, key=lambda n: (n is not None, n)) for x in names]
            hits = [[dict(zip(_HIT.names, h)) for h in x] for x in hits]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept_at), pa.array(counts, pa.int64()),
                 pa.array(hits, _HITS_ARROW), pa.array(names, pa.list_(kind))],
                names=[*columns, *_ADDED],
            )

    rows_columns = rows.columns
    return in_arrow(rows, scan, schema)


def _united(*several):
    spans = []
    for span in sorted(s for spans in several for s in spans):
        if spans and span[0] <= spans[-1][1]:
            a, b = spans[-1], span
            spans[-1] = (a[0], max(a[1], b[1]), a[2], max(a[3], b[3]))
        else:
            spans.append(span)
    return spans


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """``documents`` without the test items in them; the columns stay as they are.

    The bytes from the first to the last hit word of each run are cut out of the text.
    A document goes as a whole if more than ``max_coverage`` of its words is hit. The
    text of a clean document is not touched, also where it is NULL.
    """
    judged = contamination(documents, benchmark, window)
    hit = F.aggregate(
        "hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end_word"] - h["first_word"]
    )
    bytes_ = F.encode("text", "UTF-8")
    size = F.length(bytes_)
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("hits", lambda h: h["end_byte"]))
    ends = F.concat(F.transform("hits", lambda h: h["first_byte"]), F.array(size.cast("bigint")))
    pieces = F.zip_with(
        begins, ends,
        lambda a, b: F.decode(F.substring(bytes_, (a + 1).cast("int"), (b - a).cast("int")), "UTF-8"),
    )
    cut = F.when(F.size("hits") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    return (
        judged.where(hit <= F.lit(float(max_coverage)) * F.col("n_words"))
        .withColumn("text", cut)
        .select(*[F.col(f"`{c}`") for c in documents.columns])
    )
