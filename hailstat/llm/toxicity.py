"""Toxicity scores: lexicon trie, Levenshtein automaton, and a window of context around each term.

1. A lexicon of words and word beginnings is learnt from labelled documents: terms that stand in
   significantly more toxic texts (likelihood ratio), each with the log-odds of its texts.
2. The words of a text are matched against it: a word of the trie, a beginning of it, or, for longer
   words, one edit away from any word of the lexicon, found by running the Levenshtein automaton of the word over the trie.
   Words that are one edit away from a term but stand in clean labelled texts are words of their own.
3. The window around a match tells a quotation (quote marks around it, a word of saying near it) from use.
4. The strengths of the used, quoted and misspelled terms of a text are weighed by a logistic regression.

Learning reads at most ``SAMPLE`` labelled rows, those of the smallest hashes of doc_id. Scoring reads
every word of every text and needs no shuffle; the model (all significant terms of those rows) goes to every task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import documents

SAMPLE = 20_000
SIGNIFICANT = 30.0  # of the likelihood ratio: about 4e-8 by chance
PRECISE = 0.6
BEGINNINGS = range(3, 9)
FUZZY_LENGTH = 4
REACH = 5
KNOWN = 100_000
MOST = 10.0  # of a sum of strengths; a logistic score hardly changes beyond it

PRIOR = (-3.0, 1.0, 0.3, 0.8)  # of the intercept and of used, quoted and misspelled strength

WORD = re.compile(r"[^\W\d_]+")
QUOTES = "\"'“”„«»‘’`"
SAYING = frozenset(
    "said says wrote writes called calls quote quoted quotes word words term terms phrase saying sagte schrieb wort "
    "dit disait mot citation dijo escribió palabra cita".split()
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Trie:
    """Words with one dictionary per letter; ``None`` holds the word that ends there."""

    def __init__(self, words):
        self.root: dict = {}
        for word in words:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[None] = word

    def near(self, text: str, edits: int) -> list[tuple[int, str]]:
        """The words at most ``edits`` insertions, deletions or substitutions from ``text``, nearest first.

        The state of the automaton after a path of letters is the row of distances to all beginnings of
        ``text``; a path is left when no entry of its row is within the bound.
        """
        found = []
        stack = [(self.root, tuple(range(len(text) + 1)))]
        while stack:
            node, row = stack.pop()
            for letter, child in node.items():
                if letter is None:
                    if row[-1] <= edits:
                        found.append((row[-1], child))
                    continue
                new = [row[0] + 1]
                for i, own in enumerate(text):
                    new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (own != letter)))
                if min(new) <= edits:
                    stack.append((child, tuple(new)))
        return sorted(found)


@dataclass
class Model:
    words: dict[str, float]
    beginnings: dict[str, float]
    weights: tuple[float, ...] = PRIOR
    fuzzy: frozenset[str] = frozenset()  # words whose misspellings count
    proper: frozenset[str] = frozenset()  # near a term, but a word of its own

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """Matches and scores with one model; what it knows of words is kept up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        fuzzy = [w for w in model.words if w in model.fuzzy and len(w) >= FUZZY_LENGTH]
        self.trie = Trie(fuzzy)
        # A word at one edit from a term has, whole or without one letter, a text in common with the term.
        self.cut = {w[:i] + w[i + 1 :] for w in fuzzy for i in range(len(w))} | set(fuzzy)
        self.longest = max(map(len, fuzzy), default=0) + 1
        self.known: dict[str, tuple | None] = {}

    def term(self, word: str) -> tuple[str, float, bool] | None:
        """The term, its strength and whether it is misspelled."""
        if word in self.known:
            return self.known[word]
        found = None
        if word in self.model.words:
            found = word, self.model.words[word], False
        else:
            starts = [word[:n] for n in BEGINNINGS if word[:n] in self.model.beginnings and len(word) >= n]
            if starts:
                best = max(starts, key=self.model.beginnings.get)
                found = best + "*", self.model.beginnings[best], False
            elif len(word) >= FUZZY_LENGTH - 1 and word not in self.model.proper and self._may_be_near(word):
                near = self.trie.near(word, 1)
                if near:
                    found = near[0][1], self.model.words[near[0][1]], True
        if len(self.known) >= KNOWN:
            self.known.clear()
        self.known[word] = found
        return found

    def _may_be_near(self, word: str) -> bool:
        if len(word) > self.longest:
            return False
        return word in self.cut or any(word[:i] + word[i + 1 :] in self.cut for i in range(len(word)))

    def strengths(self, text: str) -> tuple[float, float, float]:
        """Sums over distinct terms that are used, quoted and misspelled, each up to ``MOST``: further terms say no more."""
        lower = text.lower()
        if not any(self.term(w) for w in set(WORD.findall(lower))):
            return 0.0, 0.0, 0.0
        places = list(WORD.finditer(lower))
        sums: dict[tuple[str, int], float] = {}
        for i, place in enumerate(places):
            found = self.term(place[0])
            if not found:
                continue
            term, strength, misspelled = found
            kind = 1 if self._quoted(lower, places, i) else 2 if misspelled else 0
            sums[term, kind] = strength
        return tuple(min(MOST, sum(s for (_, k), s in sums.items() if k == kind)) for kind in range(3))

    @staticmethod
    def _quoted(text: str, places: list, i: int) -> bool:
        place = places[i]
        before, after = text[max(0, place.start() - 1) : place.start()], text[place.end() : place.end() + 1]
        if before and after and before in QUOTES and after in QUOTES:
            return True
        window = places[max(0, i - REACH) : i + REACH + 1]
        left, right = text[window[0].start() : place.start()], text[place.end() : window[-1].end() + 1]
        if any(q in left for q in QUOTES[:1] + QUOTES[2:]) and any(q in right for q in QUOTES[:1] + QUOTES[2:]):
            return True
        return any(w[0] in SAYING for w in window)

    def score(self, text: str) -> float:
        z = self.model.weights[0] + sum(w * s for w, s in zip(self.model.weights[1:], self.strengths(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _count_terms(batches):
    """Per term the toxic and clean texts of a batch that hold it; ``*`` ends a beginning."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = set(words_of(text or ""))
            counts[toxic].update(own)
            counts[toxic].update({w[:n] + "*" for w in own for n in BEGINNINGS if len(w) > n})
        terms = sorted(set(counts[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())],
            ["term", "toxic", "clean"],
        )
        rest = sorted(set(counts[0]) - set(counts[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()), pa.array([counts[0][t] for t in rest], pa.int64())],
            ["term", "toxic", "clean"],
        )


def choose(rows: list[tuple[str, int, int]]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings with their log-odds, from ``(term, toxic, clean)`` counts."""
    strength = lambda a, b: round(math.log((a + 0.5) / (b + 0.5)), 3)
    words = {t: (a, b) for t, a, b in rows if not t.endswith("*")}
    starts = {t[:-1]: (a, b) for t, a, b in rows if t.endswith("*")}
    most: dict[str, int] = {}  # the toxic texts of the commonest word with a beginning
    for word, (a, _) in words.items():
        for n in BEGINNINGS:
            most[word[:n]] = max(most.get(word[:n], 0), a)
    chosen: dict[str, float] = {}
    for start in sorted(starts, key=lambda s: (len(s), s)):
        a, b = starts[start]
        if most.get(start, 0) >= 0.8 * a:
            continue  # one word stands for the beginning
        shorter = [start[:n] for n in range(1, len(start)) if start[:n] in chosen]
        if any(starts[s][0] / sum(starts[s]) >= a / (a + b) - 0.03 for s in shorter):
            continue
        chosen[start] = strength(a, b)
    kept = {w: strength(a, b) for w, (a, b) in words.items() if not any(w[:n] in chosen for n in BEGINNINGS)}
    return kept, chosen


def fit(cells: list[tuple[tuple[float, ...], int, int]]) -> tuple[float, ...]:
    """Logistic weights from ``(strengths, toxic, clean)`` counts, by Newton steps; rare kinds stay near the prior."""
    x = np.array([[1.0, *s] for s, _, _ in cells])
    pos, n = np.array([c[1] for c in cells], float), np.array([c[1] + c[2] for c in cells], float)
    prior = np.array(PRIOR)
    w, ridge = prior.copy(), np.diag([0.1, 0.1, 20.0, 20.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (pos - n * p) - ridge @ (w - prior))
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _near_words(model: Model):
    def near(batches):
        matcher = model.matcher()
        for batch in batches:
            found = set()
            for text in batch.column("text").to_pylist():
                found.update(w for w in set(words_of(text or "")) if (matcher.term(w) or (0, 0, False))[2])
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["word"])

    return near


def _strengths(model: Model):
    def strengths(batches):
        matcher = model.matcher()
        for batch in batches:
            found = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found[tuple(round(2 * s) / 2 for s in matcher.strengths(text or "")), toxic] += 1
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[0][i] for k in keys], pa.float64()) for i in range(3)), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([found[k] for k in keys], pa.int64())],
                ["used", "quoted", "misspelled", "toxic", "n"],
            )

    return strengths


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``labels(doc_id, toxic)``; labels other than 0 and 1 count for nothing, 1 wins over 0.

    At most ``sample`` labelled rows are read, those with the smallest hash of doc_id; equal texts count once. Without a toxic and
    a clean text among them the lexicon is empty and every score is low.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    labels = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most 12 bytes a row
    rows = documents(docs).join(F.broadcast(drawn), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")).persist()
    try:
        totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        if len(totals) < 2:
            return Model({}, {})
        counted = rows.mapInArrow(_count_terms, "term string, toxic long, clean long")
        counts = counted.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
        share = totals[1] / (totals[0] + totals[1])
        n, part = F.col("a") + F.col("b"), F.col("a") / (F.col("a") + F.col("b"))
        ratio = 2 * (F.col("a") * F.log(part / share) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - part) / (1 - share))).otherwise(0))
        terms = counts.where((F.col("a") > 0) & (part >= max(PRECISE, share))).withColumn("ratio", ratio).where(F.col("ratio") >= SIGNIFICANT)
        # Each is significant over at most ``sample`` texts, which bounds their number.
        words, starts = choose(sorted(tuple(r) for r in terms.select("term", "a", "b").collect()))
        model = Model(words, starts, fuzzy=frozenset(words))
        proper = rows.where("toxic = 0").mapInArrow(_near_words(model), "word string").distinct()
        model.proper = frozenset(r[0] for r in proper.collect())  # neighbours of the terms
        cells = rows.mapInArrow(_strengths(model), "used double, quoted double, misspelled double, toxic long, n long")
        cells = cells.groupBy("used", "quoted", "misspelled").agg(
            F.sum(F.expr("n * toxic")).alias("a"), F.sum(F.expr("n * (1 - toxic)")).alias("b")
        )
        model.weights = fit([((r[0], r[1], r[2]), r[3], r[4]) for r in cells.collect()])
        return model
    finally:
        rows.unpersist()


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]):
        matcher = model.matcher()
        for part in W.chunks(batches):
            scores = [matcher.score(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return score


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Per document ``doc_id, score, predicted``; null and empty texts get the score of a text without terms.

    Only the text decides; other columns are never read. Repeated rows are scored each, no rows give none.
    """
    scored = documents(docs).mapInArrow(_score(model), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(doc_id: str = "doc_id"):
    """Rows that are kept out of learning: crc32 of the id as text is a multiple of five."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, all their columns, that are not predicted toxic; the order of columns stays."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def keep(batches):
        matcher = model.matcher()
        for part in W.chunks(batches):
            stay = [matcher.score(t or "") < 0.5 for t in part.column("text").to_pylist()]
            yield part.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(keep, fields)
