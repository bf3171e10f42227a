"""Benchmark passages in training documents, by suffix arrays over shards of the training words.

A shard is a chunk of whole documents. Its suffix array holds the suffixes that can match at all: those
whose first words start some benchmark window. Every benchmark suffix is binary-searched in it; the
equal range gives all places, and the match is extended word by word to its longest verbatim length.
Nothing is shuffled while the benchmark fits one block; each block is bounded by ``BLOCK_WORDS`` and is
what every task holds, and more blocks are more passes whose hits meet by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import join_rows, placed, stored

WINDOW = 10
BLOCK_WORDS = 2_000_000
HITS = "doc_id long, place long, n_words long, hits binary, items array<string>, longest long, longest_start long, longest_item string"


@dataclass
class Benchmark:
    """The suffixes of one block of items, sorted by the hash of their window."""

    ids: list[str]
    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray  # of words
    item_end: np.ndarray  # for each word, where its item ends
    item: np.ndarray
    keys: dict[int, tuple[np.ndarray, np.ndarray]]  # window size -> sorted window hashes, their first words


def index(rows: list[tuple]) -> Benchmark:
    """The searchable form of ``(item_id, text)`` rows; items without words match nothing."""
    words = W.find_words(pa.array([r[1] for r in rows], pa.string()), W.PLAIN, lower=True)
    hashes, keys = words.hashes(), {}
    counts = words.counts
    sizes: dict[int, list] = {}
    for r, n in enumerate(counts.tolist()):
        if n:
            sizes.setdefault(min(n, WINDOW), []).append(r)
    for size, members in sizes.items():
        at = np.concatenate([np.arange(words.first[r], words.first[r + 1] - size + 1) for r in members])
        found = W.runs(hashes, at, at + size)
        order = np.argsort(found, kind="stable")
        keys[size] = found[order], at[order]
    return Benchmark(
        [str(r[0]) for r in rows], words.data.tobytes(), words.starts, words.ends, hashes,
        np.repeat(words.first[1:], counts), words.rows, keys,
    )


def _matches(words: W.Words, hashes: np.ndarray, bench: Benchmark) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each window size, places in the shard and the benchmark suffixes whose windows stand there."""
    lead = 3
    for size, (keys, suffixes) in bench.keys.items():
        at, seen = words.windows(hashes, size)
        if size > lead:  # the suffixes that can match: their first words start a benchmark window
            heads = np.unique(W.runs(bench.hashes, suffixes, suffixes + lead))
            first = W.runs(hashes, at, at + lead)
            slot = np.minimum(np.searchsorted(heads, first), len(heads) - 1)
            live = heads[slot] == first
            at, seen = at[live], seen[live]
        order = np.argsort(seen, kind="stable")  # the shard's suffix array, to the depth of a window
        at, seen = at[order], seen[order]
        low, high = np.searchsorted(seen, keys, "left"), np.searchsorted(seen, keys, "right")
        found = np.flatnonzero(high > low)
        lengths = high[found] - low[found]
        yield at[W.gather(lengths, low[found])], np.repeat(suffixes[found], lengths), size


def _search(bench: Benchmark):
    def search(batches):
        for part in W.chunks(batches):
            words = W.find_words(part.column("text"), W.PLAIN, lower=True)
            hashes, rows, n = words.hashes(), words.rows, len(part)
            row_end = words.first[1:]
            marks = [[] for _ in range(n)]
            items: list[set] = [set() for _ in range(n)]
            best = [(0, 0, "")] * n
            for places, suffixes, size in _matches(words, hashes, bench):
                if not len(places):
                    continue
                same = words.ends[places + size - 1] - words.starts[places] >= 0
                for k in range(size):  # words, not hashes alone: their lengths, then their bytes
                    a, b = places + k, suffixes + k
                    same &= (hashes[a] == bench.hashes[b]) & (words.ends[a] - words.starts[a] == bench.ends[b] - bench.starts[b])
                places, suffixes = places[same], suffixes[same]
                reach = np.full(len(places), size)
                open_ = np.arange(len(places))
                while len(open_):  # the longest verbatim match from each place
                    a, b = places[open_] + reach[open_], suffixes[open_] + reach[open_]
                    on = (a < row_end[rows[places[open_]]]) & (b < bench.item_end[suffixes[open_]])
                    open_, a, b = open_[on], a[on], b[on]
                    open_ = open_[hashes[a] == bench.hashes[b]]
                    reach[open_] += 1
                for r in np.unique(rows[places]).tolist():
                    mine = rows[places] == r
                    at = places[mine] - words.first[r]
                    marks[r].append(np.column_stack([at, np.full(len(at), size)]))
                    items[r].update(bench.ids[i] for i in np.unique(bench.item[suffixes[mine]]).tolist())
                    k = int(np.argmax(reach[mine]))
                    best[r] = max(best[r], (int(reach[mine][k]), int(at[k]), bench.ids[bench.item[suffixes[mine][k]]]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("place"), pa.array(words.counts, pa.int64()),
                 pa.array([np.unique(np.concatenate(m), axis=0).astype("<i8").tobytes() if m else b"" for m in marks], pa.binary()),
                 pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                 pa.array([b[0] for b in best], pa.int64()), pa.array([b[1] if b[0] else None for b in best], pa.int64()),
                 pa.array([b[2] if b[0] else None for b in best], pa.string())],
                [c.split()[0] for c in HITS.split(", ")],
            )

    return search


def _digest(batches):
    for batch in batches:
        hit = []
        for marks, n in zip(batch.column("hits").to_pylist(), batch.column("n_words").to_pylist()):
            total = 0
            if marks:
                runs = np.frombuffer(marks, "<i8").reshape(-1, 2)
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, runs[:, 0], 1)
                np.add.at(change, runs.sum(axis=1), -1)
                total = int((np.cumsum(change) > 0).sum())
            hit.append(total)
        lists = batch.column("items").to_pylist()
        rest = ["longest", "longest_start", "longest_item"]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("place"), batch.column("n_words"), pa.array(hit, pa.int64()), pa.array([len(i) for i in lists], pa.int64()),
             pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in lists]), pa.array([h > 0 for h in hit]),
             *(batch.column(c) for c in rest)],
            ["doc_id", "place", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", *rest],
        )


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``BLOCK_WORDS`` words (a longer item is alone), read one after another."""
    block, total = [], 0
    for row in items.select(F.col("item_id").cast("string"), "text").where("text is not null").toLocalIterator():
        size = len(row[1]) // 2 + 1
        if block and total + size > BLOCK_WORDS:
            yield block
            block, total = [], 0
        block.append((row[0], row[1]))
        total += size
    yield block


def _hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, bool]:
    """What ``benchmark_hits`` tells, and whether rows that agree in doc_id and text have been folded to one."""
    texts, blocks = placed(docs), _blocks(benchmark)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return texts.mapInArrow(_search(index(first)), HITS), False
    found = None
    for block in chain((first, second), blocks):
        part = stored(texts.mapInArrow(_search(index(block)), HITS), "hits")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("longest", "longest_start", "longest_item"))
    folded = (
        found.groupBy("doc_id", "place")
        .agg(F.max("n_words").alias("n_words"), F.concat_ws("", F.collect_set(F.hex("hits"))).alias("hits"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best.alias("best"))
        .select("doc_id", "place", "n_words", F.unhex("hits").alias("hits"), "items", "best.*")
    )
    return folded, True


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, the places and items of all windows that stand in it, and the longest match.

    ``place`` is a hash of the text. With several blocks the driver holds two of them at a time, and rows that agree
    in doc_id and text are one row here.
    """
    return _hits(docs, benchmark)[0]


def _told(hits: DataFrame) -> DataFrame:
    schema = (
        "doc_id long, place long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
        "longest long, longest_start long, longest_item string"
    )
    return hits.mapInArrow(_digest, schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and its longest match.

    Words are runs of ASCII digits, lower-cased letters and all beyond ASCII. A window is ten consecutive
    item words, or a whole shorter item; a document word is hit if it lies in a place where a window
    stands. Null and empty texts have no words; items without words match nothing; an empty benchmark
    hits nothing; items with equal texts all count. Texts are taken whole, other columns are ignored. Rows with the
    same doc_id or none are told each, whether the benchmark fills one block or many.
    """
    hits, folded = _hits(docs, benchmark)
    told = _told(hits)
    if folded:
        told = join_rows(placed(docs).select("doc_id", "place"), told)
    return told.drop("place")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all their columns, in which no benchmark window stands; rows of the same or no doc_id each."""
    dirty = _told(benchmark_hits(docs, benchmark)).where("contaminated").select("doc_id", "place").distinct()
    rows = placed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).drop("text")
    return join_rows(rows, dirty, "left_anti").select("row.*")
