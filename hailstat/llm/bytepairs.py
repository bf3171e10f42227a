"""Byte-level BPE with a rank queue, for words of any length, and its way back.

A text is split into words by the vocabulary's pattern and each word is merged by itself: of all adjacent
pairs whose joined bytes are a token, the one of least rank is merged first, of equal ones the leftmost.
The tokens of a word form a linked list. Every rank has a bucket with the positions of its pairs, and a
bitmap of two levels, 256 ranks to a lower one, says which buckets are filled: finding the first set bit
of one number a level gives the next rank without a search over the word. A merge links its token over the
right one and pushes the two new pairs; entries of pairs that are gone stay in their buckets and are
skipped when they come up. So a word of n bytes takes O(n log n), also without any space in it.

Nothing is shuffled: a row is encoded where it is read, some words at a time, so that memory grows
neither with the partition nor, beyond the text itself, with a long text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame

from hailstat.llm import words as W
from hailstat.llm.packing import vocabulary_path
from hailstat.llm.tables import documents

SOME = 100_000  # words encoded at a time
WHOLE = 1 << 20  # characters of a text whose words are found in one go
SHORT = 32  # characters of a word that is worth remembering
KNOWN = 400_000  # words remembered by a process


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word; every single byte must be a token."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n, rank_of = len(word), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # linked list over the first bytes of tokens
    pair = [rank_of(word[i : i + 2]) for i in range(n)]  # the rank of the token at a position joined with the next one
    pair[-1] = None
    buckets: dict[int, list[int]] = {}
    for i, rank in enumerate(pair):  # ascending positions are a heap
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
    low: dict[int, int] = {}
    for rank in buckets:
        low[rank >> 8] = low.get(rank >> 8, 0) | 1 << (rank & 255)
    top = 0
    for group in low:
        top |= 1 << group
    fresh: list[tuple[int, int]] = []
    while True:
        for rank, i in fresh:
            bucket = buckets.get(rank)
            if bucket:
                heappush(bucket, i)
            else:
                buckets[rank] = [i]
                group = rank >> 8
                bits = low.get(group)
                if bits:
                    low[group] = bits | 1 << (rank & 255)
                else:
                    low[group] = 1 << (rank & 255)
                    top |= 1 << group
        if not top:
            break
        group = (top & -top).bit_length() - 1
        bits = low[group]
        first = bits & -bits
        rank = group << 8 | first.bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            low[group] = bits = bits ^ first
            if not bits:
                top ^= 1 << group
        fresh = []
        if pair[i] != rank:
            continue  # stale: the pair at this position is another one by now, or none
        gone = after[i]
        end = after[i] = after[gone]
        pair[gone] = None
        if end < n:
            before[end] = i
            new = pair[i] = rank_of(word[i : after[end]])
            if new is not None:
                fresh.append((new, i))
        else:
            pair[i] = None
        left = before[i]
        if left >= 0:
            new = pair[left] = rank_of(word[left:end])
            if new is not None:
                fresh.append((new, left))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : after[i]]])
        i = after[i]
    return ids


class _Known(dict):
    """Ids of short words, at most ``KNOWN`` of them; longer ones are merged anew."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(merged(word.encode(), self.ranks))
        if len(word) <= SHORT and len(self) < KNOWN:
            self[word] = ids
        return ids


class Coder:
    """Encodes and decodes by a file of ranks, one base64 token and its rank a line."""

    def __init__(self, path: str, pattern: str | None = None):
        import public_tokenizers
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {i: token for token, i in self.ranks.items()}
        self.decimal = {i: str(i) for i in self.tokens}
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        self.known = _Known(self.ranks)

    def parts(self, text: str) -> Iterator[list[int]]:
        """The ids of the text, some words at a time."""
        words = iter(self.pattern.findall(text)) if len(text) <= WHOLE else map(lambda found: found[0], self.pattern.finditer(text))
        while some := list(islice(words, SOME)):
            yield list(chain.from_iterable(map(self.known.__getitem__, some)))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of the decimal ids joined by a space, and of the decoded bytes."""
        n, written, back = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.parts(text):
            written.update(((" " if n else "") + " ".join(map(self.decimal.__getitem__, ids))).encode())
            back.update(self.decode(ids))
            n += len(ids)
        return n, written.hexdigest(), back.hexdigest()


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def _encode(path: str):
    def encode(batches):
        own = coder(path)
        for part in W.chunks(batches):
            ids = [own.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return encode


def _decode(path: str):
    def decode(batches):
        own = coder(path)
        for batch in batches:
            back = [None if ids is None else own.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(back, pa.binary())], ["doc_id", "bytes"])

    return decode


def _digest(path: str):
    def digest(batches):
        own = coder(path)
        for part in W.chunks(batches):
            told = [own.digest(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([t[0] for t in told], pa.int64()), *(pa.array([t[k] for t in told], pa.string()) for k in (1, 2))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest


def encode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """Per row ``doc_id, ids``: the whole text by the rank file; null and empty texts have no ids.

    Rows stand for themselves: repeated and null ids, and equal texts, are encoded each. Columns besides
    ``doc_id`` and ``text`` are ignored; no rows give no rows.
    """
    return documents(docs).mapInArrow(_encode(ranks or vocabulary_path("tiktoken")), "doc_id long, ids array<int>")


def decode(coded: DataFrame, ranks: str | None = None) -> DataFrame:
    """Per row ``doc_id, bytes`` of ``doc_id, ids``; null ids give null bytes, an unknown id fails the job."""
    return coded.select("doc_id", "ids").mapInArrow(_decode(ranks or vocabulary_path("tiktoken")), "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """Per row ``doc_id, n_tokens, ids_sha256, decoded_sha256``: the ids and what they decode to, as digests.

    Rows are treated as by ``encode``; an empty text has no tokens and the digests of nothing.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents(docs).mapInArrow(_digest(ranks or vocabulary_path("tiktoken")), schema)
