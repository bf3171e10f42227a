"""Near-duplicate documents by MinHash with sequential Bayesian verification.

1. Each document becomes its set of word shingles. Documents with the same set are one class.
2. Classes get a signature of min-hashes. Classes that agree in a band of it are candidates: within a
   band's bucket every member is paired with the smallest one (a star, not all pairs).
3. Candidates are compared batch by batch of the signature. After each batch a pair is dropped if the
   posterior probability that its similarity reaches the threshold is below ``miss``.
4. Survivors are verified on full shingle sets.
5. Members of one bucket that the verified links leave in different components are compared as well, in pairs
   of blocks of at most ``BLOCK`` members and ``BLOCK_BYTES`` of sets. A component that alone fills more than a
   block has blocks of its own, which are not compared with each other. A task holds the full sets of its two
   blocks: it takes what passes 3 from the best agreement down, leaves out what its own links have joined by
   then, verifies the rest, and gives back only the links that join parts. No pair is ever a row, and from two
   blocks come fewer links than they have members; no pair of a bucket of different components stays undecided.

Shingles are 64-bit hashes of their words. Hot groups: copies fold into one class before any pair is
made; a large bucket yields one pair per member; joins on a hot class may be split by Spark. Classes have
numbers of their own, so that repeated and null ids of documents name none.
Nulls and texts without words have an empty set and no link. Long texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.components import components
from hailstat.llm.tables import documents, stored

BANDS = 32
ROWS = 6
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-5
BLOCK = 512
BLOCK_BYTES = 8 << 20  # of full sets
WIDTH = 2  # bytes of a min-hash that are kept
WORD = "[^\\x20\\x09-\\x0D]"  # what a text with words holds


def shingles(words: W.Words, hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a shorter text is one shingle."""
    n = len(hashes)
    pairs = np.zeros(n, np.uint64)
    if n >= size:
        pairs[: n - size + 1] = W.runs(hashes, np.arange(n - size + 1), np.arange(size, n + 1))
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= size:
            yield np.unique(pairs[a : b - size + 1])
        elif b > a:
            yield W.runs(hashes, np.array([a]), np.array([b]))
        else:
            yield np.zeros(0, np.uint64)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in W.chunks(batches):
        words = W.find_words(part.column("text"), W.SPACED, lower=True)
        yield part, list(shingles(words, words.hashes(), size))


@cache
def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    seeds = W.mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * W.BASE)
    return seeds[:HASHES, None] | np.uint64(1), seeds[HASHES:, None]


def signature(found: np.ndarray) -> bytes:
    """Low 16 bits of the smallest of each of the hash functions over the set."""
    a, b = _coefficients()
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(found), 512):
        values = found[None, at : at + 512] * a + b
        least = np.minimum(least, values.min(axis=1))
    return W.mix(least).astype(f"<u{WIDTH}").tobytes()


DESCRIBED = "doc_id long, place long, n_shingles long, key_a long, key_b long, signature binary"


def _describe(size: int):
    def describe(batches):
        for part, sets in _sets(batches, size):
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            known: dict[bytes, bytes] = {}
            for key, found in zip(keys, sets):
                if len(found) and key not in known:
                    known[key] = signature(found)
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("place"), pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]),
                 pa.array(halves[:, 1]), pa.array([known.get(k, b"") for k in keys], pa.binary())],
                ["doc_id", "place", "n_shingles", "key_a", "key_b", "signature"],
            )

    return describe


@cache
def least_agreement(threshold: float, miss: float) -> tuple[int, ...]:
    """For each whole number of batches, the fewest equal hashes that keep a pair.

    The similarity has a uniform prior; after m of n equal hashes its posterior is Beta(m+1, n-m+1),
    and a pair is kept while the mass at or above the threshold is at least ``miss``.
    """
    grid = np.linspace(threshold, 1, 4001)[:-1] + (1 - threshold) / 8000
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = 0
        while True:
            scale = lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            mass = np.exp(scale + m * np.log(grid) + (n - m) * np.log1p(-grid)).sum() * (1 - threshold) / 4000
            if m == n or log(max(mass, 1e-300)) >= log(miss):
                break
            m += 1
        least.append(m)
    return tuple(least)


def _promising(threshold: float, miss: float):
    least = least_agreement(threshold, miss)

    def promising(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), f"<u{WIDTH}").reshape(-1, HASHES) for c in ("sign_a", "sign_b")
            )
            alive, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for step, bound in enumerate(least):
                part = slice(step * BATCH, (step + 1) * BATCH)
                equal[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[equal[alive] >= bound]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return promising


def _agreeing(left: np.ndarray, right: np.ndarray, open_: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``open_`` (rows of left, rows of right) that pass every batch's bound, and their equal hashes."""
    pairs = np.argwhere(open_)
    equal = np.zeros(len(pairs), np.int64)
    for step, bound in enumerate(least):
        part = slice(step * BATCH, (step + 1) * BATCH)
        for at in range(0, len(pairs), 65_536):
            some = slice(at, at + 65_536)
            equal[some] += (left[pairs[some, 0], part] == right[pairs[some, 1], part]).sum(axis=1)
        keep = equal >= bound
        pairs, equal = pairs[keep], equal[keep]
    return pairs, equal


def _first_common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The first band in which the rows agree."""
    same = (left == right).reshape(len(left), BANDS, ROWS).all(axis=2)
    return same.argmax(axis=1)


def _reaches(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sets, sorted, reach the similarity."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * shared >= percent * (len(left) + len(right) - shared)


def _forest(pairs: np.ndarray, parts: np.ndarray, mine, linked) -> list[int]:
    """Of index pairs, best first, those that are linked and join two parts when their turn comes.

    ``mine`` tells which of some pairs count, ``linked`` whether one pair is a link.
    """
    part = np.unique(parts, return_inverse=True)[1]
    chosen = []
    for at in range(0, len(pairs), 4096):
        some = np.arange(at, min(at + 4096, len(pairs)))
        some = some[part[pairs[some, 0]] != part[pairs[some, 1]]]
        some = some[mine(pairs[some])]
        for k in some.tolist():
            x, y = pairs[k]
            if part[x] != part[y] and linked(x, y):
                part[part == part[y]] = part[x]
                chosen.append(k)
    return chosen


def _across(percent: int, miss: float):
    """Links that join the parts of each pair of blocks; rows arrive sorted by pair of blocks."""
    least = least_agreement(percent / 100, miss)

    def settle(group: pa.Table) -> pa.RecordBatch:
        ids, parts, own = (group.column(c).to_numpy() for c in ("node", "part", "own"))
        low, high, number = (group.column(c)[0].as_py() for c in ("low", "high", "number"))
        signs = np.frombuffer(b"".join(group.column("signature").to_pylist()), f"<u{WIDTH}").reshape(-1, HASHES)
        sets = [np.frombuffer(m.as_buffer(), "<u8") for m in group.column("members")]
        a, b = np.flatnonzero(own == low), np.flatnonzero(own == high)
        open_ = parts[a][:, None] != parts[b][None, :]
        if low == high:
            open_ &= ids[a][:, None] < ids[b][None, :]
        pairs, equal = _agreeing(signs[a], signs[b], open_, least)
        pairs = np.column_stack([a[pairs[:, 0]], b[pairs[:, 1]]])[np.argsort(-equal, kind="stable")]
        first = lambda some: _first_common(signs[some[:, 0]], signs[some[:, 1]]) == number  # noqa: E731  each pair in one bucket only
        chosen = pairs[_forest(pairs, parts, first, lambda x, y: _reaches(sets[x], sets[y], percent))]
        x, y = ids[chosen[:, 0]], ids[chosen[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def across(batches):
        held: list[pa.Table] = []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            keys = np.column_stack([rows.column(c).to_numpy() for c in ("band", "low", "high")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if held and i == 0 and [held[0].column(c)[0].as_py() for c in ("band", "low", "high")] != keys[0].tolist():
                    yield settle(pa.concat_tables(held))
                    held = []
                held.append(rows.slice(i, j - i))
                if j < len(keys):
                    yield settle(pa.concat_tables(held))
                    held = []
        if held:
            yield settle(pa.concat_tables(held))
        W.release()

    return across


def _full_sets(size: int):
    def full(batches):
        for part, sets in _sets(batches, size):
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "members"])

    return full


def _confirmed(percent: int):
    def confirmed(batches):
        for batch in W.chunks(W.chunks(batches, column="set_a"), column="set_b"):
            both = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            keep = [_reaches(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirmed


class NearDuplicates:
    """The steps over one table ``documents(doc_id, text)``; see the module.

    ``described`` has a row per document; its ``place`` is a hash of the text, so that rows with the same or no doc_id
    are told apart. ``classes`` has one row per distinct set: its ``node``, a number of its own, and the smallest
    doc_id, if any, and the place of one document.
    """

    def __init__(self, docs: DataFrame, size: int = 5, percent: int = 80, miss: float = MISS):
        self.docs, self.size, self.percent, self.miss = documents(docs).withColumn("place", F.xxhash64("text")), size, percent, miss
        self.described = stored(self.docs.mapInArrow(_describe(size), DESCRIBED), "minhash")
        folded = self.described.where("n_shingles > 0").groupBy("key_a", "key_b").agg(
            F.min("doc_id").alias("least"), F.coalesce(F.min_by("place", "doc_id"), F.min("place")).alias("place"),
            F.min("n_shingles").alias("n_shingles"),
        )
        self.classes = stored(folded.withColumn("node", F.monotonically_increasing_id()), "classes")

    def _bands(self, signed: DataFrame) -> DataFrame:
        wide = ROWS * WIDTH
        keys = [F.xxhash64(F.lit(i), F.substring("signature", i * wide + 1, wide)) for i in range(BANDS)]
        return signed.select("node", "n_shingles", F.posexplode(F.array(*keys)).alias("number", "band"))

    def _of_classes(self, rows: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
        """The rows of the classes' own documents, with ``node``; of all classes or those of ``nodes``."""
        asked = self.classes if nodes is None else self.classes.join(nodes.hint("merge"), "node", "left_semi")
        asked = asked.select("node", "least", F.col("place").alias("at"))
        met = (rows["place"] == asked["at"]) & rows["doc_id"].eqNullSafe(asked["least"])
        return rows.join(asked.hint("merge"), met).drop("at", "least", "doc_id", "place")

    def _signed(self) -> DataFrame:
        """``node, n_shingles, signature`` of every class."""
        rows = self.described.where("n_shingles > 0").select("doc_id", "place", "n_shingles", "signature")
        return self._of_classes(rows).dropDuplicates(["node"])

    def _compared(self, pairs: DataFrame, signed: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that no batch of their signatures rules out."""
        side = {c: signed.select(F.col("node").alias(c), F.col("signature").alias(f"sign_{c}")) for c in "ab"}
        both = pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "sign_a", "sign_b")
        return both.mapInArrow(_promising(self.percent / 100, self.miss), "a long, b long")

    def _full(self, nodes: DataFrame) -> DataFrame:
        """``node, members``: the full sets of the asked classes."""
        sets = self._of_classes(self.docs, nodes).mapInArrow(_full_sets(self.size), "node long, members binary")
        return stored(sets.dropDuplicates(["node"]), "sets")

    def _verified(self, alive: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose full sets reach the similarity."""
        alive = stored(alive, "alive")
        sets = self._full(alive.select(F.col("a").alias("node")).unionAll(alive.select("b")).distinct())
        full = {c: sets.select(F.col("node").alias(c), F.col("members").alias(f"set_{c}")) for c in "ab"}
        whole = alive.join(full["a"], "a").join(full["b"], "b").select("a", "b", "set_a", "set_b")
        return stored(whole.mapInArrow(_confirmed(self.percent), "a long, b long"), "confirmed")

    def _blocks(self, crowded: DataFrame, links: DataFrame) -> DataFrame:
        """Members of the buckets that ``links`` leave in several components, a row for each pair of blocks they are in.

        Blocks of a bucket are numbered from 0: those that small parts share, by a hash of the part, and then those
        of each part that is too large for one. Two blocks of the same large part are no pair.
        """
        parts = components(links)
        placed = crowded.join(parts, "node", "left").select(
            "band", "number", "node", "n_shingles", F.coalesce("component", "node").alias("part")
        )
        wide = F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("words") * 8 / BLOCK_BYTES)).cast("int")
        sizes = placed.groupBy("band", "part").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("words"))
        mixed = sizes.groupBy("band").agg(F.count("*").alias("parts")).where("parts > 1").select("band")
        sizes = stored(sizes.join(mixed, "band"), "parts")
        need = sizes.groupBy("band", "part").agg(wide.alias("blocks"))
        shared = sizes.join(need.where("blocks = 1"), ["band", "part"]).groupBy("band").agg(wide.alias("shared"))
        earlier = Window.partitionBy("band").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        large = need.where("blocks > 1").withColumn("before", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)))
        total = need.where("blocks > 1").groupBy("band").agg(F.sum("blocks").alias("own_blocks"))
        dealt = need.drop("blocks").join(large, ["band", "part"], "left").join(shared, "band", "left").join(total, "band", "left").select(
            "band", "part", "blocks", F.coalesce("shared", F.lit(0)).alias("shared"),
            (F.coalesce("shared", F.lit(0)) + F.coalesce("before", F.lit(0))).cast("int").alias("first"),
            (F.coalesce("shared", F.lit(0)) + F.coalesce("own_blocks", F.lit(0))).cast("int").alias("all"),
        )
        own = F.when(F.col("blocks").isNull(), F.pmod(F.hash("part"), "shared")).otherwise(F.col("first") + F.pmod(F.hash("node"), "blocks"))
        inside = F.col("blocks").isNotNull() & (F.col("other") >= F.col("first")) & (F.col("other") < F.col("first") + F.col("blocks"))
        spread = placed.join(dealt, ["band", "part"]).withColumn("own", own.cast("int"))
        return spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("all") - 1))).where(~inside).select(
            "band", "number", "node", "part", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
        )

    def _across(self, crowded: DataFrame, links: DataFrame, signed: DataFrame) -> DataFrame:
        """Verified links between members of one bucket that ``links`` leave in different components."""
        dealt = stored(self._blocks(crowded, links), "blocks")
        sets = self._full(dealt.select("node").distinct())
        full = signed.select("node", "signature").join(sets, "node")
        rows = dealt.join(full, "node").repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
        rows = rows.select("band", "low", "high", "number", "node", "part", "own", "signature", "members")
        return stored(rows.mapInArrow(_across(self.percent, self.miss), "a long, b long"), "across")

    def links(self) -> DataFrame:
        """Verified links ``(a, b)`` between the nodes of classes that span every component."""
        signed = stored(self._signed(), "signed")
        bands = self._bands(signed)
        leaders = bands.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("band", "a")
        crowded = stored(bands.join(leaders, "band").select("band", "number", "a", "node", "n_shingles"), "buckets")
        stars = crowded.where("a <> node").select("a", F.col("node").alias("b")).distinct()
        links = self._verified(self._compared(stars, signed))
        return links.unionAll(self._across(crowded, links, signed))

    def named(self) -> DataFrame:
        """The classes with their ``component``, by node, and ``component_id``, its smallest doc_id."""
        parts = components(self.links())
        classes = self.classes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        classes = stored(classes, "components")
        names = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        return classes.join(names, "component")

    def resolved(self) -> DataFrame:
        """``(doc_id, n_shingles, component_id)`` of every document."""
        named = self.named().select("key_a", "key_b", "component_id", F.lit(True).alias("has_words"))
        sets = self.described.select("doc_id", "n_shingles", "key_a", "key_b")
        own = F.when(F.col("has_words"), F.col("component_id")).otherwise(F.col("doc_id"))
        return sets.join(named, ["key_a", "key_b"], "left").select("doc_id", "n_shingles", own.alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``; one document of each component is kept.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets. Empty sets
    and nulls link with nothing; copies share a component; no rows give no rows; other columns are ignored.
    Rows with the same doc_id are documents of their own and may lie in different components; those that have the
    component's id are all called kept (``deduplicated`` keeps one row). A row without doc_id is never a component's
    name; a component that has no id is null, and none of its rows is kept here.
    """
    return NearDuplicates(docs, size, percent, miss).resolved().withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns, without all but one row of each component.

    That row has the component's smallest doc_id; of several such rows, and in a component without any id, one row
    of one set stays. Rows without words are in no component and all stay, whatever their ids.
    """
    best = Window.partitionBy("component").orderBy(F.asc_nulls_last("least"), "node")
    first = NearDuplicates(docs, size, percent).named().withColumn("rank", F.row_number().over(best)).where("rank = 1")
    first = first.select("least", F.col("place").alias("at"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col("row.text").cast("string")
    filled = F.coalesce(text.rlike(WORD), F.lit(False))
    rows = whole.where(filled).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("place"))
    chosen = rows.join(first.hint("merge"), (rows["place"] == first["at"]) & rows["doc_id"].eqNullSafe(first["least"]))
    one = Window.partitionBy("doc_id", "place").orderBy(F.lit(0))
    chosen = chosen.withColumn("rank", F.row_number().over(one)).where("rank = 1").select("row.*")
    return chosen.unionAll(whole.where(~filled).select("row.*"))
