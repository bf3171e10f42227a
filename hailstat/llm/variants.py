"""Spelling variants of words: all pairs at edit distance one, through PartEnum signatures of letter multisets.

1. Words are runs of Latin letters. Documents are counted where they are read and only counts are shuffled.
2. A word's letter multiset is a binary vector over (letter, how many times seen before). One inserted or
   deleted letter changes one component, one replaced letter two: words at edit distance one have vectors
   at Hamming distance at most two.
3. PartEnum: the components are dealt to ``PARTS`` parts. Two differences lie in two parts at most, so the
   vectors agree in all others: for every choice of two parts a word has a signature of its components
   outside them. One edit also leaves the first three letters or the last four alone, so a signature comes in
   two forms, with either; any near pair shares one of them.
4. Words are equi-joined on signatures, and a pair is kept if its edit distance is one. The check is part of
   the join, so that a bucket's pairs that are not near never leave it; a bitmap of the letters that occur an
   odd number of times, which one edit changes in two places at most, spares most of them the full check.
5. A word's form is its most frequent near word if that is ``RATIO`` times as frequent; roots follow forms by
   pointer doubling. Counts grow ``RATIO``-fold with each form, so the rounds are the logarithm of a logarithm.

Hot words are one row after counting. A document, however long, is cut between runs and counted part by part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import documents, stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
SLIP = 31
PARTS = 4
HEAD = LEAST_LENGTH // 2  # letters; an edit behind them leaves them alone, any other one the last of TAIL
TAIL = LEAST_LENGTH - HEAD
HELD = 500_000  # words counted by a task before it hands them on
SLICE = 1 << 20  # characters of a text that are counted at a time
RUN = re.compile("[A-Za-zÀ-ÿ]+")
OTHER = re.compile("[^A-Za-zÀ-ÿ]")


def slices(text: str) -> Iterator[str]:
    """The text in parts that no run crosses."""
    start = 0
    while start < len(text):
        found = OTHER.search(text, start + SLICE)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def slipped(doc_id: int | None, text: str) -> Counter:
    """The runs of a text, lower-cased in A-Z, one letter deleted from those that the checksum names."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for part in slices(text):
        for run, n in Counter(RUN.findall(part.encode().lower().decode())).items():
            h = zlib.crc32(run.encode(), prefix)
            if h % SLIP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= LEAST_LENGTH:
                out[run] += n
    return out


def _count(batches):
    held: Counter = Counter()

    def given():
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if text.is_valid:
                held.update(slipped(doc_id, text.as_py()))
                if len(held) > HELD:
                    yield given()
    yield given()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of ``LEAST_LENGTH`` letters or more that occur ``LEAST_COUNT`` times or more."""
    counted = documents(docs).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _affixes(words: list[str]) -> np.ndarray:
    """Two numbers per word: of its first letters and of its last ones."""
    cut = [[zlib.crc32(w[:HEAD].encode()), zlib.crc32(w[-TAIL:].encode()) | 1 << 32] for w in words]
    return W.mix(np.array(cut, np.uint64).reshape(-1, 2) * W.BASE)


def odd_letters(words: list[str]) -> np.ndarray:
    """One bit per letter (modulo 64): whether it occurs an odd number of times."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    sums = np.bitwise_xor.accumulate(np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << (letters & np.uint64(63))]))
    return sums[ends] ^ sums[np.append(0, ends[:-1])]


def signatures(words: list[str]) -> np.ndarray:
    """One row per word: hashes of its vector outside each choice of two parts, with its first and with its last letters."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    order = np.lexsort((letters, owner))  # equal letters of a word side by side
    same = letters[order]
    opens = np.ones(len(same), bool)
    opens[1:] = (same[1:] != same[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(same))
    seen = at - np.maximum.accumulate(np.where(opens, at, 0))
    component = W.mix((same << np.uint64(32) | seen.astype(np.uint64)) * W.BASE)
    part = (component >> np.uint64(40)) % np.uint64(PARTS)
    sums = np.zeros((len(words), PARTS), np.uint64)
    np.add.at(sums, (owner, part.astype(np.int64)), W.mix(component))
    total = sums.sum(axis=1)
    left_out = list(combinations(range(PARTS), 2))
    salts = np.arange(1, len(left_out) + 1, dtype=np.uint64) * W.BASE
    affixes = _affixes(words).T
    return np.column_stack([
        W.mix((total - sums[:, i] - sums[:, j] + salt) ^ affix) for (i, j), salt in zip(left_out, salts) for affix in affixes
    ])


def _sign(batches):
    for batch in batches:
        for part in W.chunks(iter([batch]), column="word", limit=1 << 18):
            if part.num_rows:
                words = part.column("word").to_pylist()
                signs, odd = signatures(words).astype("<i8"), odd_letters(words).astype("<i8")
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(signs) + 1) * signs.shape[1], pa.int32()), pa.array(signs.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("n"), pa.array(odd), lists], ["word", "n", "odd", "signatures"])


def near_words(counted: DataFrame) -> DataFrame:
    """``word, n, near, near_n`` of all ordered pairs at edit distance one among the distinct words of ``counted(word, n)``."""
    signed = counted.mapInArrow(_sign, "word string, n long, odd long, signatures array<long>")
    signed = signed.select("word", "n", "odd", F.explode("signatures").alias("signature"))
    right = signed.select("signature", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("odd").alias("near_odd"))
    few = F.bit_count(F.col("odd").bitwiseXOR(F.col("near_odd"))) <= 2
    near = few & (F.col("word") < F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    pairs = signed.hint("merge").join(right, (signed["signature"] == right["signature"]) & near)
    pairs = stored(pairs.select("word", "n", "near", "near_n").distinct(), "near-words")
    return pairs.unionAll(pairs.select("near", "near_n", "word", "n"))


def roots(forms: DataFrame, hops: int) -> DataFrame:
    """``(word, root)`` for every word of ``forms(word, form)``, none of whose chains has more than ``hops`` steps."""
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(hops)) if hops > 1 else 0):
        found = stored(found, "roots")
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return found


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Per word ``word, n, n_near, form, form_n, root``.

    Two words are near if one inserted, deleted or replaced code point makes one of the other. The form is
    the near word of largest n (ties: smallest in code-point order) if its n is at least ``RATIO`` times the
    word's, else null; the root is where the chain of forms ends. Null and empty texts have no words; a null
    doc_id counts as an empty one in the checksum; repeated rows count each; other columns are ignored; no
    rows, or none with words, give no rows.
    """
    counted = stored(word_counts(docs), "words")
    near = near_words(counted)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    told = counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= RATIO * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("found"),
    )
    told = stored(told.select("word", "n", "n_near", "found.*"), "variants")
    most = counted.agg(F.max("n")).first()[0] or LEAST_COUNT
    hops = max(1, int(log(most / LEAST_COUNT, RATIO)) + 1)
    ends = roots(told.where("form IS NOT NULL"), hops)
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
