"""Encoding whole texts by their pre-tokens, with a memory for those seen before.

The byte-level tokenizers here split a text by a fixed pattern and encode each piece
for itself. A space between two characters that are not white space always begins a
piece, and a lone line feed between two such characters always is one. So a text can be
cut there without changing its ids, and what is between two cuts can be remembered:
natural text consists of few words that are repeated often. The memory is bounded.
"""

import re
from collections.abc import Callable, Sequence
from itertools import islice

#: Entries of the memory. When it is full it is emptied, so it holds what is in use.
MEMORY = 400_000
#: Words that outlast a task.
KEPT = 50_000
#: Longer pieces are encoded every time.
LONGEST = 64

#: Characters that count as white space for one library and not for another.
_DOUBTFUL = "\x1c\x1d\x1e\x1f\x85\u180e\u200b\u2060\ufeff"
_SAFE = rf"[^\s{_DOUBTFUL}]"
_CUT = re.compile(rf"(?<={_SAFE}) (?={_SAFE})")
#: Marks at the end of a word, and characters that are letters for every library.
_MARKS = ".,;:!?"
_LETTERS = frozenset(c for c in map(chr, range(0x100)) if c.isalpha() and c not in "\xaa\xb5\xba")


class _Awkward(Exception):
    """White space next to a space: the text must be cut with more care."""


def _solid(piece: str) -> bool:
    """Begins and ends with characters that are certainly not white space."""
    return bool(piece) and not (
        piece[0].isspace() or piece[-1].isspace() or piece[0] in _DOUBTFUL or piece[-1] in _DOUBTFUL
    )


class _Spaced(dict):
    """Word to ids of a space and the word."""

    def __init__(self, owner):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str) -> bytes:
        if not _solid(word):
            raise _Awkward
        return self.owner.learn(self, word, " ")


class _Bare(_Spaced):
    """Word to ids of the word alone."""

    def __missing__(self, word: str) -> bytes:
        if not _solid(word):
            raise _Awkward
        return self.owner.learn(self, word, "")


class Encoder:
    """``encode`` gives the ids of a text as bytes, by a function that encodes any text.

    ``many``, if given, encodes a list of words at once, which is faster where calls are dear:
    with a space before each, or as they are, for which it may put line feeds between them. With it a
    mark between a letter and the end of a word must be a piece; so words are learnt without it. A text
    in which one of ``added`` occurs is encoded in one go. At most ``memory`` words are remembered.
    """

    def __init__(
        self, whole: Callable[[str], bytes],
        many: Callable[[list[str], str], list[bytes]] | None = None,
        added: Sequence[str] = (),
        memory: int = MEMORY,
    ):
        self.whole, self.many, self.added, self.memory = whole, many, added, memory
        self.spaced, self.bare = _Spaced(self), _Bare(self)
        self.line_feed = whole("\n")
        self.marks = {mark: whole(mark) for mark in _MARKS}

    def learn(self, memory: dict, word: str, before: str) -> bytes:
        if "\n" in word:
            lines = word.split("\n")
            if all(map(_solid, lines)):  # each line feed stands alone
                bare = self.bare
                return self.line_feed.join([memory[lines[0]], *(bare[x] for x in lines[1:])])
        ids = self.whole(before + word)
        if len(word) <= LONGEST:
            if len(memory) >= self.memory:
                memory.clear()
            memory[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(map(text.__contains__, self.added)):
            return self.whole(text)
        words = text.split(" ")
        known = list(map(self.spaced.get, words))
        known[0] = self.bare.get(words[0])
        if None not in known:
            return b"".join(known)
        new = [i for i, ids in enumerate(known) if ids is None]
        if self.many is not None:
            self._prepare({words[i] for i in new if i})
        try:
            for i in new:
                known[i] = self.spaced[words[i]] if i else self.bare[words[0]]
        except _Awkward:
            return self._with_care(text)
        return b"".join(known)

    def forget(self, keep: int = KEPT) -> None:
        """Leaves the ``keep`` words learnt first, which are the common ones.

        An idle Python worker holds on to what it has, next to whatever runs after it.
        """
        for memory in (self.spaced, self.bare):
            if len(memory) > keep:
                first = list(islice(memory.items(), keep))
                memory.clear()
                memory.update(first)

    def _prepare(self, words: set[str]) -> None:
        """Learns new words together, those within lines with a space and those that begin one without."""
        spaced, bare = set(), set()
        for word in words:
            if word.isalnum() or (word[:-1].isalnum() and word[-1] in _MARKS):
                spaced.add(word)  # certainly solid
                continue
            first, *rest = word.split("\n")
            if all(map(_solid, (first, *rest))):
                spaced.add(first)
                bare.update(rest)
        for memory, new, before in ((self.spaced, spaced, " "), (self.bare, bare, "\n")):
            new = {w for w in new if w not in memory and len(w) <= LONGEST}
            marked = [w for w in new if w[-1] in _MARKS and w[-2:-1] in _LETTERS]
            new.difference_update(marked)
            new.update([stem for w in marked if (stem := w[:-1]) not in memory])
            if len(memory) + len(new) + len(marked) > self.memory:
                memory.clear()
            if len(new) > 1:
                new = list(new)
                memory.update(zip(new, self.many(new, before)))
            for word in marked:
                memory[word] = memory[word[:-1]] + self.marks[word[-1]]

    def _with_care(self, text: str) -> bytes:
        pieces = _CUT.split(text)
        ids = [self._piece(self.bare, pieces[0], "")]
        ids += [self._piece(self.spaced, piece, " ") for piece in pieces[1:]]
        return b"".join(ids)

    def _piece(self, memory: dict, piece: str, before: str) -> bytes:
        return memory[piece] if _solid(piece) and "\n" not in piece else self.whole(before + piece)
