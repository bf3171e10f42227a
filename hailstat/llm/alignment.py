"""Token alignment of two tokenizers over the same bytes, and how often their tokens meet.

1. Each text is encoded by both tokenizers. The tokens' byte lengths give cumulative ends; two dictionaries
   map an end to the token's index, the intersection of their key sets, sorted, cuts both id lists into groups.
   No token of either crosses a single space between other characters, so such a space always begins a group:
   the distinct words of a chunk of documents are aligned once, as one text, and a document's groups are those of
   its words. Texts with other white space around a space are aligned whole.
2. Links are expanded group by group: a group with one token on a side links it with all of the other side,
   any other group links the tokens whose byte ranges overlap.
3. Corpus counts: how many documents hold an id pair linked, and the highest count of each A id.
4. Every document is told how its links fare against these counts.

Counts are taken where documents are read: a chunk of whole documents keeps one dictionary of its distinct
id pairs with their number of documents, and the documents refer to it by position. Only dictionaries are
shuffled for counting, once per chunk however often a pair stands in it, and only dictionaries are joined
with the counts; they come back to their chunk's documents in one sorted pass. No pair of a frequent token
is a row per document, and no table of counts has to fit in a task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import documents, stored

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
CHUNK_BYTES = 6 << 20
SOME = 200  # words in a text
# Where a space does not stand alone between other characters, and the sign that the pieces write a space with.
BLANK = "[\\s\\pZ\\x{1c}-\\x{1f}\\x{85}]"
ODD = f"^{BLANK}|{BLANK}$|{BLANK} | {BLANK}|\u2581"
HIGH = np.uint64(32)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself where it prints, else as the next free code point from 256."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printed)]
    return {**{chr(b): b for b in printed}, **{chr(256 + i): b for i, b in enumerate(others)}}


class ByteLevel:
    """A byte-level BPE file whose merges stand in the order of their ids; special tokens are plain text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = {t["content"] for t in told["added_tokens"] if t["special"]}
        letters = byte_of_letter()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in told["model"]["vocab"].items() if piece not in special}
        self.tokens = {i: token for token, i in ranks.items()}
        self.coder = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(" " + text)


class Pieces:
    """A piece vocabulary with byte fallback, no piece of which goes on behind a space; it puts one before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = {i: self._bytes(i) for i in range(self.coder.get_piece_size())}
        if any(b" " in token.lstrip(b" ") for token in self.tokens.values()):
            raise ValueError("pieces that go on behind a space are not supported")

    def _bytes(self, i: int) -> bytes:
        piece = self.coder.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.coder.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.coder.encode(text, num_threads=1)

    def encode_words(self, words: list[str]) -> list[int]:
        """The ids of words with a space between them; in short texts, as a long one costs more than its parts."""
        texts = [" ".join(words[i : i + SOME]) for i in range(0, len(words), SOME)]
        return list(chain.from_iterable(self.coder.encode(texts, num_threads=1)))


@cache
def _coders(first: str, second: str) -> tuple:
    out = []
    for coder in (ByteLevel(first), Pieces(second)):
        lengths = np.zeros(max(coder.tokens) + 1, np.int64)
        for i, token in coder.tokens.items():
            lengths[i] = len(token)
        out += [coder, lengths]
    return tuple(out)


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each group, one past its last token in both lists: the ends that both have, in order."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = sorted(index_a.keys() & index_b.keys())
    return tuple(np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (index_a, index_b))


def links(ends_a: np.ndarray, ends_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of overlapping tokens, expanded group by group."""
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    from_a, from_b = cut_a - n_a, cut_b - n_b
    one = np.minimum(n_a, n_b) == 1
    size = np.maximum(n_a, n_b)[one]
    step = W.gather(size, np.zeros(len(size), np.int64))
    a = np.repeat(from_a[one], size) + np.where(np.repeat(n_a[one] > 1, size), step, 0)
    b = np.repeat(from_b[one], size) + np.where(np.repeat(n_b[one] > 1, size), step, 0)
    rest_a, rest_b = (W.gather(n[~one], start[~one]) for n, start in ((n_a, from_a), (n_b, from_b)))
    stops = np.union1d(ends_a[rest_a], ends_b[rest_b])  # up to each end in the other groups lies one token of either side
    return np.concatenate([a, np.searchsorted(ends_a, stops)]), np.concatenate([b, np.searchsorted(ends_b, stops)])


@cache
def _written(size: int) -> list[str]:
    return [f"{i}{mark}" for mark in ",|;" for i in range(size)]


def parts(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size: int) -> list[str]:
    """The ids in decimal, group by group, each with the mark behind it: ``,``, ``|`` or ``;``."""
    table = _written(size)
    code_a, code_b = a.copy(), b.copy()
    code_a[cut_a - 1] += size
    code_b[cut_b - 1] += 2 * size
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + np.repeat(cut_b - n_b, n_a)] = code_a
    codes[np.arange(len(b)) + np.repeat(cut_a, n_b)] = code_b
    return list(map(table.__getitem__, codes.tolist()))


def written(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size: int) -> str:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids in decimal."""
    return "".join(parts(a, b, cut_a, cut_b, size))[:-1]


def aligned(text: str | None, first: str, second: str) -> tuple | None:
    """Ids, their cuts into groups and the linked index pairs of one text; None where the bytes do not agree."""
    if not text:
        return None
    one, size_a, two, size_b = _coders(first, second)
    a, b = one.encode(text), two.encode(text)
    whole = b" " + text.encode()
    if b"".join(map(one.tokens.__getitem__, a)) != whole or b"".join(map(two.tokens.__getitem__, b)) != whole:
        return None
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    cut_a, cut_b = groups(ends_a, ends_b)
    return a, b, cut_a, cut_b, *links(ends_a, ends_b, cut_a, cut_b)


@dataclass
class AlignedWords:
    """Distinct words behind a space each: numbers per word, its groups in writing, and its linked id pairs."""

    good: np.ndarray  # whether the bytes agree
    counts: np.ndarray  # a row per word: tokens of both sides, groups, links
    written: list[str]
    first: np.ndarray  # where the links of each word begin, and their number
    pairs: np.ndarray


def align_words(words: list[str], first: str, second: str) -> AlignedWords:
    one, size_a, two, size_b = _coders(first, second)
    good = np.ones(len(words), bool)
    a, b = one.encode(" ".join(words)), two.encode_words(words)
    whole = (" " + " ".join(words)).encode()
    if b"".join(map(one.tokens.__getitem__, a)) != whole or b"".join(map(two.tokens.__getitem__, b)) != whole:
        good = np.array([aligned(w, first, second) is not None for w in words])
        kept = [w for w, g in zip(words, good) if g]
        a, b = (one.encode(" ".join(kept)), two.encode_words(kept)) if kept else ([], [])
    n = int(good.sum())
    word_ends = np.cumsum([len(w.encode()) + 1 for w, g in zip(words, good) if g], dtype=np.int64)
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    cut_a, cut_b = groups(ends_a, ends_b)
    link_a, link_b = links(ends_a, ends_b, cut_a, cut_b)
    word_of = np.searchsorted(word_ends, ends_a)[link_a]
    order = np.argsort(word_of, kind="stable")
    last = [np.searchsorted(ends, word_ends) + 1 for ends in (ends_a, ends_b, ends_a[cut_a - 1])]
    n_a, n_b, n_groups = (np.diff(x, prepend=0) for x in last)
    counts = np.zeros((len(words), 4), np.int64)
    counts[good] = np.column_stack([n_a, n_b, n_groups, np.bincount(word_of, minlength=n)]) if n else 0
    told = parts(a, b, cut_a, cut_b, max(len(size_a), len(size_b)))
    stops = np.cumsum(n_a + n_b).tolist()
    texts = iter(["".join(told[i:j])[:-1] for i, j in zip([0, *stops], stops)])
    pairs = (a[link_a].astype(np.uint64) << HIGH | b[link_b].astype(np.uint64))[order]
    return AlignedWords(good, counts, [next(texts) if g else "" for g in good], np.append(0, np.cumsum(counts[:, 3])), pairs)


def align_texts(column: pa.Array, first: str, second: str) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Per text of a chunk: its numbers and digest, its linked id pairs and how often it holds each."""
    none = (0, 0, 0, 0, ""), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = max(len(t) for t in _coders(first, second)[1::2])
    column = pc.fill_null(column, "")
    odd = pc.or_(pc.match_substring_regex(column, ODD), pc.equal(pc.binary_length(column), 0)).to_numpy(zero_copy_only=False)
    even = np.flatnonzero(~odd)
    lists = pc.split_pattern(column.take(pa.array(even)), " ")
    coded = lists.flatten().dictionary_encode()
    own = align_words(coded.dictionary.to_pylist(), first, second) if len(even) else None
    index, bounds = coded.indices.to_numpy(), lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(even) else 0)
    at = 0
    for r in range(len(column)):
        if odd[r]:
            found = aligned(column[r].as_py(), first, second)
            if found is None:
                yield none
                continue
            a, b, cut_a, cut_b, link_a, link_b = found
            numbers, text = (len(a), len(b), len(cut_a), len(link_a)), written(a, b, cut_a, cut_b, size)
            linked = a[link_a].astype(np.uint64) << HIGH | b[link_b].astype(np.uint64)
        else:
            words = index[bounds[at] : bounds[at + 1]]
            at += 1
            if not own.good[words].all():
                yield none
                continue
            numbers = own.counts[words].sum(axis=0).tolist()
            text = ";".join(map(own.written.__getitem__, words.tolist()))
            linked = own.pairs[W.gather(own.counts[words, 3], own.first[words])]
        pairs, often = np.unique(linked, return_counts=True)
        yield (*numbers, hashlib.sha256(text.encode()).hexdigest()), pairs, often


ALIGNED = "chunk long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at binary, times binary, pairs array<long>, documents array<long>"
NAMES = [field.split()[0] for field in ALIGNED.split(", ")]


def _align(first: str, second: str):
    """Two kinds of rows: 0 is a chunk's dictionary of id pairs, 1 a document that refers to it by position."""

    def align(batches):
        number = TaskContext.get().partitionId() << 32
        for part in W.chunks(batches, limit=CHUNK_BYTES):
            if not part.num_rows:
                continue
            told, codes, times = zip(*align_texts(part.column("text"), first, second))
            known, at, docs = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
            at = np.split(at.astype("<u4"), np.cumsum([len(c) for c in codes])[:-1])
            if len(known):
                yield _rows([number], [0], [None], [(None,) * 5], [None], [None], [known.astype(np.int64)], [docs])
            yield _rows(
                [number] * len(told), [1] * len(told), part.column("doc_id"), told, [x.tobytes() for x in at],
                [x.astype("<u4").tobytes() for x in times], [None] * len(told), [None] * len(told),
            )
            number += 1

    return align


def _rows(chunk, kind, doc_id, told, at, times, pairs, docs) -> pa.RecordBatch:
    n_a, n_b, n_groups, n_links, digest = zip(*told)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(kind, pa.int32()), doc_id if isinstance(doc_id, pa.Array) else pa.array(doc_id, pa.int64()),
         *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()),
         pa.array(at, pa.binary()), pa.array(times, pa.binary()), pa.array(pairs, longs), pa.array(docs, longs)],
        NAMES,
    )


def align(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """The chunks' dictionaries and documents; see ``_align``."""
    work = _align(first or tokenizer_path(FIRST), second or tokenizer_path(SECOND))
    return documents(docs).mapInArrow(work, ALIGNED)


def pair_counts(aligned_rows: DataFrame) -> DataFrame:
    """``pair, n, best``: the documents that hold an id pair linked (A id in the high half), and whether n is its A id's highest."""
    parts = aligned_rows.where("kind = 0").select(F.explode(F.arrays_zip("pairs", "documents")).alias("of"))
    counted = parts.groupBy(F.col("of.pairs").alias("pair")).agg(F.sum("of.documents").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counted.select("pair", "n", (F.col("n") == highest).alias("best"))


def _fare(batches):
    """Rows sorted by chunk, its dictionary first; ``counted`` is n of a pair, negative if it is not its A id's highest."""
    chunk, counts, best = None, None, None
    for batch in batches:
        kinds = batch.column("kind").to_pylist()
        out, n_best, total = [], [], []
        for r, kind in enumerate(kinds):
            if kind == 0:
                value = batch.column("counted")[r].values.to_numpy()
                chunk, counts, best = batch.column("chunk")[r].as_py(), np.abs(value), value > 0
                continue
            at = np.frombuffer(batch.column("at")[r].as_py(), "<u4")
            often = np.frombuffer(batch.column("times")[r].as_py(), "<u4").astype(np.int64)
            if len(at) and batch.column("chunk")[r].as_py() != chunk:
                raise ValueError("documents without their chunk's dictionary")
            out.append(r)
            n_best.append(int(often[best[at]].sum()) if len(at) else 0)
            total.append(int((often * counts[at]).sum()) if len(at) else 0)
        if out:
            rows = batch.take(pa.array(out))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(n_best, pa.int64()),
                 pa.array(total, pa.int64()), rows.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def alignment(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` are the links whose pair's count is the highest of its A id, ``count_sum`` adds the counts of all
    links. Null and empty texts, and those whose bytes either tokenizer changes, have no tokens: zeros and ''.
    Rows stand for themselves, repeated and null ids too, and count as a document each. Texts are taken whole;
    columns besides ``doc_id`` and ``text`` are ignored; no rows give no rows.
    """
    rows = stored(align(docs, first, second), "aligned")
    counts = pair_counts(rows)
    asked = rows.where("kind = 0").select("chunk", F.posexplode("pairs").alias("i", "pair"))
    signed = F.when(F.col("best"), F.col("n")).otherwise(-F.col("n"))
    answers = asked.join(counts, "pair").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("i", signed.alias("v")))).alias("found"))
    none = F.lit(None)
    dictionaries = answers.select(
        "chunk", F.lit(0).alias("kind"), *(none.cast("long").alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
        none.cast("string").alias("groups_sha256"), none.cast("binary").alias("at"), none.cast("binary").alias("times"), F.col("found.v").alias("counted"),
    )
    own = rows.where("kind = 1").drop("pairs", "documents").withColumn("counted", none.cast("array<long>"))
    both = own.unionByName(dictionaries).repartition("chunk").sortWithinPartitions("chunk", "kind")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return both.mapInArrow(_fare, schema)
