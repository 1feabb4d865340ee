"""Every query over the smallest tables, against SQL or plain Python."""

import zlib
from pathlib import Path

import base64
import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from votestream.llm.line_dedup import MIN_CHARS
from votestream.llm.queries import ORACLE_SQL, QUERIES


def rows(query, spark, sf_dir):
    found = [tuple(r) for r in QUERIES[query](spark, sf_dir).collect()]
    by_id = {r[0]: r[1:] for r in found}
    assert len(by_id) == len(found)
    return by_id


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, small, name):
    with duckdb.connect() as db:
        for table in Path(small[0]).glob("*.parquet"):
            db.sql(f"create view {table.stem} as select * from '{table}'")
        wanted = db.sql(ORACLE_SQL[name])
        columns = sorted(wanted.columns)
        expected = sorted(wanted.select(*columns).fetchall(), key=repr)
    found = QUERIES[name](spark, small[0])
    assert sorted(found.columns) == columns
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == expected


def test_the_driver_has_every_query(spark):
    import __spark_entry__ as driver

    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert {n for n in driver.queries() if n.startswith("op")} == set(QUERIES)


def test_op1(spark, small):
    sf_dir, docs = small
    found = QUERIES["op1_passages"](spark, sf_dir).collect()
    near = {}
    for d, text in docs.items():
        w = brute.WORDS.findall(brute.low(text))
        for i in range(len(w) - 49):
            near.setdefault(tuple(w[i : i + 50]), set()).add(d)
    repeated = set().union(*(v for v in near.values() if len(v) > 1))
    named = {r.doc_id for r in found} | {r.other_id for r in found}
    assert repeated and repeated <= named
    # Others share at least long parts of a passage with the one they are paired with.
    for r in found:
        assert r.similarity >= 0.8 and r.n_words >= 50
        assert len(brute.shingles(docs[r.doc_id], 5) & brute.shingles(docs[r.other_id], 5)) >= 30


def test_op3(spark, small):
    sf_dir, docs = small
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted, start = {}, 0
    for d in sorted(docs):
        ids = tokenizer.encode(docs[d] or "", add_special_tokens=False).ids + [0]
        wanted[d] = (start, len(ids), zlib.crc32(brute.packed(ids)))
        start += len(ids)
    assert rows("op3_token_files", spark, sf_dir) == wanted


def test_op4(spark, small):
    sf_dir, docs = small
    assert rows("op4_suffix_dedup", spark, sf_dir) == brute.repeats(docs)


def test_op5(spark, small):
    sf_dir, docs = small
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert rows("op5_decontamination", spark, sf_dir) == brute.contamination(docs, items)


def test_op6_on_what_it_has_not_seen(spark):
    sf_dir = "/root/testdata/sf0.1"
    if not Path(sf_dir).exists():
        pytest.skip(sf_dir)
    found = rows("op6_toxicity", spark, sf_dir)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    unseen = {d: v for d, v in found.items() if zlib.crc32(str(d).encode()) % 4 == 2}
    assert all(v[0] == (d in unseen) and 0 <= v[1] <= 1 and v[2] == (v[1] >= 0.3) for d, v in found.items())
    toxic = [v[2] for d, v in unseen.items() if labels.get(d) == 1]
    clean = [v[2] for d, v in unseen.items() if labels.get(d) == 0]
    assert sum(toxic) >= 0.85 * len(toxic) > 50 and sum(clean) <= 0.02 * len(clean)


def test_op7(spark, small):
    sf_dir, docs = small
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = {}
    for d, text in docs.items():
        ids = known.encode_ordinary(text or "")
        wanted[d] = (len(ids), brute.sha(brute.packed(ids)), brute.sha((text or "").encode()))
    assert rows("op7_byte_bpe", spark, sf_dir) == wanted


def test_op9(spark, small):
    sf_dir, docs = small
    found = rows("op9_quality", spark, sf_dir)
    assert {d: v[:6] for d, v in found.items()} == {d: brute.statistics(t) for d, t in docs.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for d, v in found.items():
        assert not (v[5] and v[6])
        if labels.get(d) == 1 and not v[5]:
            assert v[6]


def test_op10(spark, small):
    sf_dir, docs = small
    wanted = {d: (n, c, c == d) for d, (n, c) in brute.components(docs, 3, 85).items()}
    assert rows("op10_near_dedup", spark, sf_dir) == wanted


def test_pipeline(spark, small):
    """Stage by stage in plain Python, given which documents the outlier test keeps."""
    sf_dir, docs = small
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sources = {r.doc_id: r.source for r in table.collect()}
    verdicts = rows("op9_quality", spark, sf_dir)
    docs = {d: t for d, t in docs.items() if verdicts[d][6]}

    sites, first = {}, {}
    trim = lambda x: x.strip(" \t\r\x0b\x0c")
    for d in sorted(docs):
        for i, line in enumerate(docs[d].split("\n")):
            if len(trim(line)) >= MIN_CHARS:
                sites.setdefault(trim(line), set()).add(sources[d])
                first.setdefault(trim(line), (d, i))
    rest = {}
    for d, text in docs.items():
        lines = text.split("\n")
        kept = [x for i, x in enumerate(lines)
                if len(sites.get(trim(x), ())) < 10 or first[trim(x)] == (d, i)]
        if len(kept) == len(lines) or brute.WORDS.search("\n".join(kept)):
            rest[d] = "\n".join(kept)
    docs = {d: rest[d] for d, (_, c) in brute.components(rest, 5, 80).items() if c == d}

    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = brute.contamination(docs, items)
    clean = {d: t for d, t in docs.items() if not hits[d][4]}
    cut = {d for d in docs if hits[d][4] and 2 * hits[d][1] <= hits[d][0]}

    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(found) == set(clean) | cut
    for d, text in clean.items():
        assert found[d].decoded_sha256 == brute.sha(text.encode())
        assert len(found[d].ids) == 4 * found[d].n_tokens
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
