"""Near copies: large groups in proportion, and rows with repeated or no ids."""

import random
import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from hailstat.llm import minhash  # noqa: E402


def changed(n, words=100, swaps=5, seed=1):
    """Texts that each change some words of one base text: pairs are alike, few reach the similarity."""
    pick = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        text = list(base)
        for i in pick.sample(range(words), swaps):
            text[i] = f"x{k}_{i}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("swaps", [3, 5])
def test_links_that_leave_the_tasks_grow_in_proportion(spark, monkeypatch, swaps):
    monkeypatch.setattr(minhash, "BLOCK", 64)
    found = {}
    for n in (100, 200):
        texts = changed(n, swaps=swaps)
        near = minhash.NearDuplicates(brute.docs(spark, texts), 2, 80)
        links = near.links().distinct().count()
        found[n] = links
        rows = {r.doc_id: r.component_id for r in near.resolved().collect()}
        ids = dict(enumerate(texts))
        assert rows == brute.components(ids, brute.near_links(ids, 2, 80))
    assert found[200] <= 3 * found[100] + 200


def test_blocks_of_large_parts(spark, monkeypatch):
    """Two large groups and strays in shared buckets, with blocks of a few members."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    texts = changed(60, words=150, swaps=2, seed=2) + changed(40, words=150, swaps=9, seed=3) + ["quite another text"] * 3
    rows = {r.doc_id: r.component_id for r in minhash.near_duplicates(brute.docs(spark, texts), 2, 80).collect()}
    ids = dict(enumerate(texts))
    assert rows == brute.components(ids, brute.near_links(ids, 2, 80))


ONE = " ".join(f"a{i}" for i in range(60))
TWO = " ".join(f"b{i}" for i in range(60))
ROWS = [
    (7, ONE), (7, TWO), (7, ONE), (8, TWO), (9, ONE + " more"), (None, "only here " + TWO[:50]), (None, "only here " + TWO[:50]),
    (None, ONE), (None, None), (3, ""), (3, ""), (None, " "), (None, "another text without an id at all"),
]


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("node", __import__("pyspark").sql.functions.lit("x"))
    told = sorted((tuple(r) for r in minhash.near_duplicates(docs, 2, 80).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    expected = [
        (7, 59, 7, True), (7, 59, 7, True), (7, 59, 7, True), (8, 59, 7, False), (9, 60, 7, False), (None, 59, 7, False),
        (3, 0, 3, True), (3, 0, 3, True), (None, 0, None, False), (None, 0, None, False),
    ]
    rest = [t for t in told if t not in expected]
    assert all(e in told for e in expected) and len(rest) == 3
    assert all(r[0] is None and r[2] is None and not r[3] and r[1] > 0 for r in rest)
    kept = sorted((r.doc_id, r.text) for r in minhash.deduplicated(docs, 2, 80).collect() if r.doc_id is not None)
    # One row of each group: the texts one and two are two groups that both have 7 as their smallest id.
    assert kept == sorted([(7, ONE), (7, TWO), (3, ""), (3, "")])
    without = [r.text for r in minhash.deduplicated(docs, 2, 80).collect() if r.doc_id is None]
    assert sorted(map(str, without)) == sorted(map(str, [ROWS[5][1], None, " ", ROWS[12][1]]))
    assert minhash.deduplicated(docs, 2, 80).columns == docs.columns
