"""Words are learnt once, with and without a mark behind them, and texts keep the library's ids."""

import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from votestream.llm.pretokens import Encoder
from votestream.llm.token_files import _encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_word_with_a_mark_behind_it_is_learnt_without_it():
    asked = []

    def many(words, before):
        asked.extend(words)
        return [w.encode() for w in words]

    encoder = Encoder(str.encode, many)
    encoder.encode("first stone. stone, stone! stone\nhill; hill. 7. (x).")
    assert sorted(asked) == ["(x).", "7.", "hill", "stone"]
    assert "stone." in encoder.spaced and "stone," in encoder.spaced


@pytest.mark.parametrize("text", [
    "one two. two, two two; three! three? three: 3. 3 3, a. a", "x.\ny,\nz! w.\nw", "don't. don't 's. 's, it's, it's.",
    "a.. a... a.b a.b. b.: (a). (a) \"a\". -a. a-. _a. a_.", "größe. größe, ß. ß é. ﬁ. ﬁ, 漢字. 漢字, ª. ª º, µ. µ",
    "é. é a​. a​, x­. \U0001d400. \U0001d400", ". , ; a . a , a", "." * 70 + " " + "a" * 63 + ". " + "a" * 64 + ".",
])
def test_ids_are_those_of_the_whole_text(text):
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    encoder = _encoder(PATH)
    for _ in range(2):
        assert encoder.encode(text) == struct.pack(f"<{len(ids)}i", *ids)
