"""Documents: near copies, repeats, contamination, lines, packing, against plain versions."""

import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from hailstat.llm import contamination, lines, minhash, packing, substrings  # noqa: E402
from hailstat.llm import words as W  # noqa: E402

LONG = " ".join(f"w{i}" for i in range(3000))
BASE = [f"a{i}" for i in range(120)]
AWKWARD = [
    None, "", " \n\t ", "one", "ONE", "two words", LONG, LONG, " ".join(BASE), " ".join([*BASE[:60], "changed", *BASE[61:]]),
    " ".join(BASE[:40]) + " x  double  space ", "the same same same same same same same same same same same same same same same same same "
    "same same same same same same same same", "  é Ü <|endoftext|> it's 12,5 \n\n end ", " ".join(BASE),
]


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def tables(spark):
    empty = brute.docs(spark, AWKWARD).limit(0)
    return {"awkward": brute.docs(spark, AWKWARD), "sample": brute.sample(spark), "empty": empty}


KINDS = ["awkward", "sample", "empty"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(tables, kind, size):
    texts = texts_of(tables[kind])
    expected = brute.components(texts, brute.near_links(texts, size, 80))
    rows = minhash.near_duplicates(tables[kind], size).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert all(r.n_shingles == len(brute.shingles(texts[r.doc_id], size)) and r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len(rows) == len(texts)


def test_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    words = [f"b{i}" for i in range(100)]
    texts = [" ".join([*words[: k % 7], *[f"x{k}_{j}" for j in range(3 + 2 * (k % 6))], *words[k % 7 :]]) for k in range(40)]
    df = brute.docs(spark, texts)
    expected = brute.components(range(40), brute.near_links(dict(enumerate(texts)), 2, 80))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 2).collect()} == expected


def test_pruning_bounds_rise_with_evidence():
    least = minhash.least_agreement(0.8, 1e-7)
    assert list(least) == sorted(least) and 0 < least[0] < minhash.BATCH and least[-1] < 0.8 * minhash.HASHES


@pytest.mark.parametrize("kind", KINDS)
def test_substrings(tables, kind):
    expected = brute.without_repeats(texts_of(tables[kind]))
    rows = substrings.substring_dedup(tables[kind]).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected


def test_windows_that_only_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(W, "mix", lambda x: x * np.uint64(0))
    import pyarrow as pa

    same = [" ".join(f"{c}{i}" for i in range(20)) for c in "aabab"]
    later, _, _ = substrings._later(np.arange(5), np.zeros(5, np.int64), np.ones(5, np.int64), pa.array(same))
    assert later.tolist() == [False, True, False, True, True]


@pytest.mark.parametrize("kind", KINDS)
def test_contamination(spark, tables, kind):
    items = [(1, " ".join(BASE[5:30])), (2, "ONE"), (3, None), (4, ""), (10, "ONE"), (5, " ".join(BASE[20:32]).upper()), (6, "same " * 12)]
    if kind == "sample":
        items += [tuple(r) for r in brute.sample(spark, "benchmark").select("item_id", "text").collect()]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.contaminated(texts_of(tables[kind]), items)
    rows = contamination.contamination(tables[kind], bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == expected
    clean = contamination.decontaminated(tables[kind], bench)
    assert clean.columns == tables[kind].columns
    assert {r.doc_id for r in clean.collect()} == {d for d, e in expected.items() if not e[4]}


def test_benchmark_in_blocks_gives_the_same(spark, tables, monkeypatch):
    bench = brute.sample(spark, "benchmark")
    whole = {tuple(r)[:6] for r in contamination.contamination(tables["sample"], bench).collect()}
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 2000)
    assert {tuple(r)[:6] for r in contamination.contamination(tables["sample"], bench).collect()} == whole


def test_empty_benchmark_hits_nothing(tables, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in contamination.contamination(tables["awkward"], bench).collect())


def test_lines(spark):
    site_line, copy = "subscribe to our news", "first of a copy\nshared middle\nlast of a copy"
    texts = [f"own {i}\n{site_line}\nend {i}" for i in range(24)] + [copy] * 24 + [None, "", "\n"]
    rows = [(i, t, f"s{i % 12}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in lines.line_dedup(df).collect()}
    assert all(out[i].text == f"own {i}\nend {i}" and (out[i].n_lines, out[i].n_removed) == (3, 1) for i in range(24))
    assert all(out[i].text == copy and out[i].n_removed == 0 for i in range(24, 48))
    assert out[48].text is None and out[48].n_lines == 0 and out[49].text == "" and out[50].text == "\n"
    assert lines.line_dedup(df.limit(0)).count() == 0
    cleaned = lines.clean_lines(df.selectExpr("*", "99L AS n_chars", "'x' AS line", "1 AS gone"))
    assert cleaned.columns == ["doc_id", "text", "source", "n_chars", "line", "gone"]
    assert {r.doc_id: r.n_chars for r in cleaned.collect()}[3] == len("own 3\nend 3")


@pytest.mark.parametrize("kind", KINDS)
def test_packing(tables, kind):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.vocabulary_path())
    rows = packing.pack(tables[kind]).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    texts = texts_of(tables[kind])
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = np.array([*coder.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for k, own in sequences.items():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) == packing.LENGTH or k == max(sequences)


def test_windows_hold_the_target_shares(spark):
    rows = [(i, "word " * 400, "big" if i % 4 else "small") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = packing.pack(df, {"big": 0.5, "small": 0.5}).collect()
    half = packing.WINDOW_SEQUENCES
    small = sum(r.length for r in found if r.sequence_id < half and r.source == "small")
    assert abs(small - 0.5 * half * packing.LENGTH) <= 2 * packing.LENGTH


def test_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    first, second = 2**60 + 1, 2**60 + 3  # not exact as floating point
    df = spark.createDataFrame([(None, text), (first, text), (second, text), (5, None), (None, "x")], "doc_id long, text string")
    removed = [(r.doc_id, r.n_removed) for r in substrings.substring_dedup(df).collect()]
    assert sorted(removed, key=str) == sorted([(None, 0), (first, 0), (second, 40), (5, 0), (None, 0)], key=str)
    parts = {(r.doc_id, r.n_shingles): r.component_id for r in minhash.near_duplicates(df, 2).collect()}
    assert parts == {(None, 39): first, (first, 39): first, (second, 39): first, (5, 0): 5, (None, 1): None}
