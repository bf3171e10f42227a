"""Removal of word runs that repeat an earlier place, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. Consecutive windows whose smallest
``MINIMISER``-word hash is the same travel together as one packed string of words, to the bucket of
that hash; equal windows have equal minimisers and so meet in one bucket. There, sorting brings equal
windows together and the earliest place of each is known exactly: hashes only propose equality, the
words themselves decide. Every other place is marked, and a last step per document removes the words
that marked windows cover.

Before they travel, equal packed strings of one part of a partition fold into the first of them: the
others repeat an earlier place by construction, so only their marks go on. A passage that a third of all
documents share therefore sends one string per part and not one per document. All strings of a part for
one bucket are one compressed row, and a task holds one bucket at a time; there are ``FINE`` buckets to
a shuffle partition. The marks of a document meet as runs of window starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import documents

WINDOW = 20
MINIMISER = 4
FINE = 8
PART_BYTES = 4 << 20
PACKED = "bucket long, blob binary"
MARKED = "doc_id long, marks binary"


def smallest_of(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` consecutive values."""
    reach, least = 1, values
    while reach * 2 <= size:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _blob(docs: np.ndarray, starts: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> bytes:
    """Places and packed strings of one bucket; without strings, runs that are marked already."""
    sizes = np.array([len(t) for t in texts], np.int64)
    head = np.array([len(docs), len(texts)], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*(a.astype("<i8").tobytes() for a in (head, docs, starts, counts, sizes)), *texts]))


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, k = np.frombuffer(raw, "<i8", 2).tolist()
    numbers = np.frombuffer(raw, "<i8", 3 * n + k, 16)
    return numbers[:n], numbers[n : 2 * n], numbers[2 * n : 3 * n], numbers[3 * n :], raw[16 + 8 * (3 * n + k) :]


def _by_bucket(buckets: np.ndarray, docs: np.ndarray, starts: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
    order = np.argsort(buckets, kind="stable")
    keys, cuts = np.unique(buckets[order], return_index=True)
    blobs = []
    for rows in np.split(order, cuts[1:]) if len(keys) else []:
        blobs.append(_blob(docs[rows], starts[rows], counts[rows], [texts[i] for i in rows.tolist()] if texts else []))
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(blobs, pa.binary())], ["bucket", "blob"])


def _pack(buckets: int):
    def pack(batches):
        for part in W.chunks(batches, limit=PART_BYTES):
            part = part.filter(pc.is_valid(part.column("doc_id")))
            words = W.find_words(part.column("text"), W.SPACED, lower=False)
            n = len(words.starts) - WINDOW + 1
            if n <= 0:
                continue
            hashes = words.hashes()
            pieces = W.runs(hashes, np.arange(len(hashes) - MINIMISER + 1), np.arange(MINIMISER, len(hashes) + 1))
            least = smallest_of(pieces, WINDOW - MINIMISER + 1)
            rows = words.rows
            valid = rows[:n] == rows[WINDOW - 1 :]
            new = valid.copy()
            new[1:] &= ~(valid[:-1] & (rows[1:n] == rows[: n - 1]) & (least[1:] == least[:-1]))
            opens = np.flatnonzero(new)
            after = valid.copy()
            after[:-1] &= ~valid[1:] | new[1:]
            closes = np.flatnonzero(after)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            docs, starts, counts = ids[rows[opens]], opens - words.first[rows[opens]], closes - opens + 1
            earliest = np.lexsort((starts, docs))
            data, first, repeats, texts = words.data.tobytes(), set(), [], []
            begins, ends = words.starts[opens].tolist(), words.ends[closes + WINDOW - 1].tolist()
            for i in earliest.tolist():
                text = data[begins[i] : ends[i]]
                repeats.append(text in first)
                if not repeats[-1]:
                    first.add(text)
                    texts.append(text)
            again = np.array(repeats, bool)
            fresh, old = earliest[~again], earliest[again]
            yield _by_bucket(least[opens[fresh]] % np.uint64(buckets), docs[fresh], starts[fresh], counts[fresh], texts)
            if len(old):
                yield _by_bucket(W.mix(docs[old].astype(np.uint64)) % np.uint64(buckets), docs[old], starts[old], counts[old], [])

    return pack


def _same_words(texts: bytes, words: W.Words, mine: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Whether the windows at ``mine`` have the words of those at ``base``; neighbours are read as one run."""
    equal = np.zeros(len(mine), bool)
    order = np.argsort(mine)
    new = np.concatenate([[True], (np.diff(mine[order]) != 1) | (np.diff(base[order]) != 1)])
    opens = np.flatnonzero(new)
    closes = np.append(opens[1:], len(order)) - 1
    spans = [side[order[k]] for side in (mine, base) for k in (opens, closes)]
    begin, end = words.starts, words.ends
    for i, j, a, b, c, d in zip(
        opens.tolist(), closes.tolist(), begin[spans[0]].tolist(), end[spans[1] + WINDOW - 1].tolist(),
        begin[spans[2]].tolist(), end[spans[3] + WINDOW - 1].tolist(),
    ):
        if texts[a:b] == texts[c:d] or texts[a:b].split() == texts[c:d].split():
            equal[order[i : j + 1]] = True
        else:
            for k in order[i : j + 1].tolist():
                left, right = (texts[begin[x[k]] : end[x[k] + WINDOW - 1]].split() for x in (mine, base))
                equal[k] = left == right
    return equal


def _later(docs: np.ndarray, starts: np.ndarray, counts: np.ndarray, packed: pa.Array):
    """Which windows of the packed strings have an equal one at an earlier place."""
    words = W.find_words(packed, W.SPACED, lower=False)
    at = W.gather(counts, words.first[:-1])
    row = np.repeat(np.arange(len(counts)), counts)
    hashes = W.runs(words.hashes(), at, at + WINDOW)
    place = starts[row] + at - words.first[row]
    later = np.zeros(len(at), bool)
    order = np.argsort(hashes)
    again = hashes[order][1:] == hashes[order][:-1]
    several = order[np.concatenate([again, [False]]) | np.concatenate([[False], again])]
    if len(several):
        several = several[np.lexsort((place[several], docs[row[several]], hashes[several]))]
        head = np.concatenate([[True], hashes[several][1:] != hashes[several][:-1]])
        first = several[np.maximum.accumulate(np.where(head, np.arange(len(several)), 0))]
        others, first = several[~head], first[~head]
        texts = words.data.tobytes()
        equal = _same_words(texts, words, at[others], at[first])
        later[others[equal]] = True
        # Windows that share no more than the hash with the first of their kind, in order of place.
        seen: set[tuple] = set()
        for i in others[~equal].tolist():
            window = tuple(texts[words.starts[at[i]] : words.ends[at[i] + WINDOW - 1]].split())
            later[i] = window in seen
            seen.add(window)
    return later, row, place


def _runs_by_document(docs: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(docs, kind="stable")
    ids, cuts = np.unique(docs[order], return_index=True)
    runs = np.column_stack([starts, counts])[order].astype("<i8")
    marks = [r.tobytes() for r in np.split(runs, cuts[1:])] if len(ids) else []
    return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(marks, pa.binary())], ["doc_id", "marks"])


def _settle(blobs: list[bytes]):
    """The marks of one bucket."""
    told = [_unblob(b) for b in blobs]
    for docs, starts, counts, sizes, _ in told:
        if not len(sizes):
            yield _runs_by_document(docs, starts, counts)
    told = [t for t in told if len(t[3])]
    if not told:
        return
    docs, starts, counts, sizes = (np.concatenate([t[i] for t in told]) for i in range(4))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    packed = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(b"".join(t[4] for t in told)))
    later, row, place = _later(docs, starts, counts, packed)
    new = np.concatenate([[True], row[1:] != row[:-1]])
    opens = np.flatnonzero(later & (new | np.concatenate([[True], ~later[:-1]])))
    closes = np.flatnonzero(later & np.concatenate([new[1:] | ~later[1:], [True]]))
    yield _runs_by_document(docs[row[opens]], place[opens], closes - opens + 1)


def _bucket(batches):
    """Rows arrive sorted by bucket; a bucket may go on in the next batch."""
    current, held = None, []
    for batch in batches:
        for key, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
            if key != current and held:
                yield from _settle(held)
                held = []
            current = key
            held.append(blob.as_py())
    if held:
        yield from _settle(held)


def covered(starts: np.ndarray, lengths: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Words of a text of ``n`` that lie in one of the windows of the runs."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths + window - 1, -1)
    return np.cumsum(change)[:n] > 0


def _clean(batches):
    for part in W.chunks(batches):
        words = W.find_words(part.column("text"), W.SPACED, lower=False)
        data = words.data.tobytes()
        removed, digests, texts = [], [], []
        for r, marks in enumerate(part.column("marks").to_pylist()):
            a, b = words.first[r], words.first[r + 1]
            keep = np.ones(b - a, bool)
            if marks:
                runs = np.concatenate([np.frombuffer(m, "<i8").reshape(-1, 2) for m in marks])
                keep = ~covered(runs[:, 0], runs[:, 1], b - a)
            begins, ends = words.starts[a:b][keep].tolist(), words.ends[a:b][keep].tolist()
            kept = b" ".join([data[x:y] for x, y in zip(begins, ends)])
            removed.append(int(b - a - len(begins)))
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(texts)],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``(doc_id, marks)``: runs of windows that stand earlier as well, in any number of rows per document."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = documents(docs).mapInArrow(_pack(FINE * partitions), PACKED)
    spread = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return spread.mapInArrow(_bucket, MARKED)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256, kept`` (the words that stay).

    A word goes if a window that covers it also starts at an earlier place: a smaller doc_id, or the same
    document and an earlier start. Null and empty texts, and texts shorter than a window, keep all they
    have. Of equal texts the one with the smallest doc_id stays whole. Texts are taken whole, other
    columns are ignored, no rows give no rows; doc_id must be unique, and texts without one are left as they are.
    """
    marks = repeated_windows(docs).groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))
    joined = documents(docs).join(marks, "doc_id", "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(_clean, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
