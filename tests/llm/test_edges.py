"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from votestream.llm.bpe import decode_ids, encode_texts
from votestream.llm.chat import format_chats, read_turns
from votestream.llm.decontamination import contamination, decontaminated
from votestream.llm.graph import components
from votestream.llm.line_dedup import merged_sketches, lines_of, site_sketches, without_boilerplate
from votestream.llm.near_dedup import near_duplicates
from votestream.llm.passages import near_duplicate_passages
from votestream.llm.quality import of_quality, quality
from votestream.llm.suffix_dedup import without_repeats
from votestream.llm.token_files import read_token_ids, token_index, write_token_ids
from votestream.llm.toxicity import Lexicon, learn, with_scores

LONG = " ".join(f"word{i} of{i % 7}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))


@pytest.fixture
def odd(documents):
    """The same text three times, of which twice in one row; nulls, nothing, and a long text."""
    return documents(
        (1, PASSAGE, "en", "a"), (2, PASSAGE, None, None), (2, PASSAGE, None, None), (3, None, "en", "a"),
        (4, "", None, "b"), (None, "lonely words", "en", "a"), (5, LONG, "en", "b"), (6, " \n\t ", "en", "a"),
        (7, f"Before. {PASSAGE} after it.", "de", "c"),
    ).select("*", *[F.lit(9).alias(c) for c in (
        "n_words", "hits", "tag", "rep", "band", "ids", "score", "kept", "spans", "vector", "n_removed")])


@pytest.fixture
def none(documents):
    return documents((0, "", "", "")).where("doc_id < 0")


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_passages(odd, none):
    found = near_duplicate_passages(odd)
    assert pairs(found, "doc_id", "other_id") == [(2, 1), (7, 1)]
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found.collect()}
    assert spans[2] == [(0, 70)] and spans[7][0][0] <= 1 and spans[7][0][1] >= 71
    assert near_duplicate_passages(none).count() == 0


def test_passages_of_unlike_texts_under_one_common_line(documents):
    """The first text has only the line; the others still find each other."""
    line = " ".join(f"common{i}" for i in range(30))
    own = [" ".join(f"t{k}x{i}" for i in range(90)) for k in range(4)]
    both = f"{line} {PASSAGE}"
    found = near_duplicate_passages(documents(*[f"{t} {line} {t}z" for t in own], both, f"x {both} y"))
    assert (5, 4) in pairs(found, "doc_id", "other_id")


def test_chats(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted int"
    rows = [
        (1, 1, "assistant", r"<\|im_end|> and <|im_start|> and <|other|>", 0), (1, 0, "user", None, 0),
        (2, None, "a\nb<|n|>", "<|im_start|>", 0), (2, 5, "assistant", "", 0), (2, 5, "assistant", "é😀", 0),
        (None, 0, None, "x<|", 0), (3, 0, "assistant", "long " * 100_000, 0), (4, 0, "user", r"<\\|", 0),
    ]
    back = {r.conv_id: r for r in read_turns(format_chats(spark.createDataFrame(rows, schema))).collect()}
    turns = {k: [tuple(t) for t in r.turns] for k, r in back.items()}
    assert turns[1] == [("user", ""), ("assistant", rows[0][3])]
    assert turns[2] == [("a\nb<|n|>", "<|im_start|>"), ("assistant", ""), ("assistant", "é😀")]
    assert turns[None] == [("", "x<|")] and turns[4] == [("user", r"<\\|")]
    assert back[1].loss_text == rows[0][3] and back[2].loss_text == "é😀" and back[None].loss_text == ""
    assert back[3].loss_text == "long " * 100_000
    assert "<|other|>" in back[1].formatted.replace("<\\|other", "<|other")
    assert format_chats(spark.createDataFrame([], schema)).count() == 0


def test_a_turn_without_conflict_is_left_as_it_is(spark):
    rows = [(1, 0, "user", "<|im_end|>"), (1, 1, "user", r"a <b| <|c|>")]
    formatted = format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).first()
    assert formatted.formatted == (
        "<|im_start|>user\n<\\|im_end|><|im_end|>\n<|im_start|>user\na <b| <|c|><|im_end|>\n")


def test_token_files(spark, odd, none, tmp_path):
    path, tokenizer = str(tmp_path / "ids"), public_tokenizers.path("byte_bpe_50k.json")
    write_token_ids(odd, tokenizer, path)
    index = token_index(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in index] == [None, 1, 2, 2, 3, 4, 5, 6, 7]
    assert [r.start for r in index] == [sum(r.n_tokens for r in index[:i]) for i in range(len(index))]
    assert [r.n_tokens for r in index if r.doc_id in (3, 4)] == [1, 1]
    assert pairs(read_token_ids(spark, path, [3, 77]), "doc_id", "ids") == [(3, [0])]
    plan = read_token_ids(spark, path, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [EqualTo(doc_id,3)]" in plan or "In(doc_id" in plan or "doc_id" in plan
    write_token_ids(none, tokenizer, str(tmp_path / "none"))
    assert token_index(spark, str(tmp_path / "none")).count() == 0


def test_suffixes(odd, none, documents):
    found = without_repeats(odd).collect()
    cut = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans]) for r in found]
    size = len(PASSAGE)
    assert (1, size, [(0, size)]) in cut and cut.count((2, size, [(0, size)])) == 2
    seven = next(s for d, _, s in cut if d == 7)
    assert seven[0][0] in (7, 8) and seven[0][1] - seven[0][0] >= size
    assert next(s for d, _, s in cut if d == 5) == [] and (3, 0, []) in cut and (4, 0, []) in cut
    assert without_repeats(none).count() == 0
    texts = ["ab" * 150, "x" * 450, "é" * 120 + "b", "y" * 199]
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.first for s in r.spans), len(r.spans),
                      hashlib.sha256(r.kept).hexdigest()) for r in without_repeats(documents(*texts)).collect()}
    assert got == brute.repeats(dict(enumerate(texts)))


def test_hot_anchors_are_counted_instead(documents):
    shared = "".join(f"{i}-" for i in range(90))
    texts = [f"{i * 7919} {shared[: 200 + 3 * i]} {i * i}" for i in range(12)]
    for limit in (1, 10_000):
        got = {r.doc_id: sum(s.end - s.first for s in r.spans)
               for r in without_repeats(documents(*texts), sort_blocks=limit).collect()}
        assert got == {d: v[1] for d, v in brute.repeats(dict(enumerate(texts))).items()}


ITEM = "item_id bigint, text string"


def test_contamination(spark, odd, none):
    items = [(1, PASSAGE), (2, "before shared0"), (3, None), (4, "... !"), (None, "lonely"), (1, PASSAGE)]
    for words in (1000, 1):  # in one block and in several
        found = contamination(odd, spark.createDataFrame(items, ITEM), block_words=words)
        assert found.columns[-3:] == ["n_words", "hits", "items"]
        by = {(r.doc_id, r.text): r for r in found.collect()}
        assert by[1, PASSAGE]["items"] == [1] and by[7, f"Before. {PASSAGE} after it."]["items"] == [1, 2]
        assert by[None, "lonely words"]["items"] == [None] and by[3, None].n_words == 0
        assert [tuple(h)[:2] for h in by[7, f"Before. {PASSAGE} after it."].hits] == [(0, 71)]
        assert by[5, LONG].hits == [] and by[5, LONG].n_words == 120_000
    empty = spark.createDataFrame([], ITEM)
    assert contamination(odd, empty).where("size(hits) > 0").count() == 0
    assert contamination(none, empty).count() == 0
    kept = decontaminated(odd, spark.createDataFrame([(1, PASSAGE)], ITEM), max_coverage=1.0)
    assert kept.columns == odd.columns
    texts = {r.doc_id: r.text for r in kept.where("doc_id is not null").collect()}
    assert texts[7] == "Before.  after it." and texts[1] == "" and texts[3] is None
    assert 7 not in {r.doc_id for r in decontaminated(odd, spark.createDataFrame([(1, PASSAGE)], ITEM)).collect()}


def test_toxicity(spark, odd, none, documents):
    labels = "doc_id bigint, toxic int, quality int"
    assert learn(odd, spark.createDataFrame([], labels)).score("x") == pytest.approx(0, abs=1e-9)
    assert learn(none, spark.createDataFrame([(1, None, 1), (None, 1, 1)], labels)).weights == {}
    rows = [(i, f"some text {'vile' if i % 2 else 'vile tale'} number {i} {'nasty' if i % 2 else ''}", "en", "a")
            for i in range(80)]
    own = learn(documents(*rows), spark.createDataFrame([(i, i % 2, 1) for i in range(80)], labels))
    assert " nasty " in own.weights and own.score("N4STY n@sty") > 0.5 > own.score("tale")
    scored = with_scores(odd, own)
    assert scored.count() == 9 and scored.where("score < 0 or score > 1 or score is null").count() == 0
    assert with_scores(none, Lexicon({})).count() == 0


def test_bpe(odd, none):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    for r in decode_ids(encode_texts(odd, path, pattern), path, pattern).collect():
        assert r.decoded.decode() == (r.text or "")
    assert encode_texts(none, path, pattern).count() == 0


def test_lines(spark, documents, none, odd):
    common = "This line stands on every site."
    rows = [(i, f"{common}\nown line number {i} of this text\n  {common}\t", "en", f"s{i}") for i in range(12)]
    rows += [(20, common, "en", None), (21, None, "en", "s1"), (22, "", None, "s2"), (20, common, "en", None)]
    found = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in without_boilerplate(documents(*rows)).collect()}
    assert (0, 3, 1, f"{common}\nown line number 0 of this text") in found
    assert (5, 3, 2, "own line number 5 of this text") in found
    assert (20, 1, 1, "") in found and (21, 0, 0, None) in found and (22, 0, 0, "") in found
    nine = documents(*[r for r in rows if r[0] < 9])
    assert without_boilerplate(nine).where("n_removed > 0").count() == 0
    assert without_boilerplate(none).count() == 0 and without_boilerplate(odd).count() == 9
    lines = lines_of(documents(*rows))
    halves = [site_sketches(lines.where(F.col("doc_id") % 2 == i)) for i in (0, 1)]
    count = F.hll_sketch_estimate("sites")
    assert pairs(merged_sketches(*halves), "line", count) == pairs(site_sketches(lines), "line", count)


def test_quality(odd, none, documents):
    found = quality(odd).collect()
    assert len(found) == 9
    by = {r.doc_id: r for r in found}
    assert by[3].n_words == 0 and by[3].base_failed and not by[3].kept and by[1].kept and by[5].n_words == 120_000
    assert of_quality(odd).columns == odd.columns
    assert pairs(of_quality(odd), "doc_id") == [(1,), (2,), (2,), (5,), (7,)]
    assert quality(none).count() == 0 and of_quality(none).count() == 0
    # No three words in a row come twice: the base rules pass them.
    prose = ["Fox%d jumped%d over one lazy%d dog%d." % (i, i, i, i) for i in range(12)]
    rows = [(k, " ".join(f"{s} {k}w{i}" for i, s in enumerate(prose)), "en", "a") for k in range(150)]
    rows.append((999, " ".join(f"{w}$$$###" for w in rows[0][1].split()), "en", "a"))
    kept = {r.doc_id for r in quality(documents(*rows)).where("kept").collect()}
    assert kept == set(range(150))


def test_near_duplicates(odd, none, documents):
    found = near_duplicates(odd)
    assert len(found.columns) == 4
    assert pairs(found, "doc_id", "component_id", "kept") == sorted([
        (1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True),
        (7, 1, False), (None, None, True)], key=repr)
    assert near_duplicates(none).count() == 0
    words = [f"w{i}" for i in range(120)]
    texts = ["Few words", "few WORDS", " ".join(words)]
    texts += [" ".join([*words[:i], "changed", *words[i + 1 :]]) for i in range(0, 120, 3)]
    texts += [" ".join([*words[: 120 - i], *(f"n{i}x{k}" for k in range(i))]) for i in range(0, 60, 2)]
    for size, cent in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id)
               for r in near_duplicates(documents(*texts), size, cent / 100).collect()}
        assert got == brute.components(dict(enumerate(texts)), size, cent)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(50, 60)] + [(7, 7), (None, 3), (8, 9), (9, 8)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{i: 50 for i in range(50, 60)}, 100: 50}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stages(spark, small, odd, none):
    for docs, rows in ((odd, 9), (none, 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small[0])
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= rows


def test_token_files_as_the_library_encodes(spark, documents, tmp_path):
    """Special strings are special, and rows that share a doc_id say where their own ids lie."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "x<|endoftext|>", "plain words here", "plain", None, "one two three four"]
    rows = [(1, t, "en", "s") for t in texts] + [(2, "<|endoftext|>", "en", "s"), (0, "first", "en", "s")]
    write_token_ids(documents(*rows), path, str(tmp_path / "ids"))
    wanted = sorted((i, *library.encode(t or "", add_special_tokens=False).ids, 0) for i, t, *_ in rows)
    found = read_token_ids(spark, str(tmp_path / "ids")).collect()
    assert sorted((r.doc_id, *r.ids) for r in found) == wanted and (1, 64, 220, 50256, 275, 0) in wanted
    # The ids one after the other, as the places in the index say.
    index = sorted(token_index(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    assert [r.start for r in index] == [sum(x.n_tokens for x in index[:i]) for i in range(len(index))]
    in_files = [(r.doc_id, list(r.ids)) for r in spark.read.orc(str(tmp_path / "ids")).orderBy("doc_id", "before").collect()]
    assert [(r.doc_id, r.ids_crc32) for r in index] == [(i, zlib.crc32(brute.packed(ids))) for i, ids in in_files]
