"""Near-duplicate vectors by a pivot-permutation index.

Vectors of each length have pivots and lists of their own, as a cosine needs equal lengths.
Pivots are at most ``PIVOTS`` of a sample of ``SAMPLE`` vectors of a length (those of the smallest hashes of their values),
taken in turn if their cosine with every earlier pivot is below ``APART``: pivots inside one dense group
would be in a different order for each of its members. A vector is described by its nearest ``NEAREST``
pivots in order. Two vectors are candidates if at least ``SHARED`` pivots are
common to their descriptions; the inverted lists are therefore keyed by groups of ``SHARED`` pivots, which
is the same as counting shared pivots in lists of single ones, without the long lists of popular pivots.
Candidates are verified by cosine in double precision.

Vectors with equal values fold into one before anything is listed. A long list is cut into blocks of about
``BLOCK`` vectors, and every pair of blocks is a task's work of its own; a pair of vectors is counted in the
first of the lists that hold both. Tasks give link counts and a forest of links, never all pairs.
The index is fitted on the pivots only; every vector is listed. Recall against brute force is in the README.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.components import components
from hailstat.llm.tables import stored

SAMPLE = 2048
PIVOTS = 96
APART = 0.7
NEAREST = 6
SHARED = 3
COSINE = 0.9
BLOCK = 1024


def valid_units(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Unit vectors in double precision of the valid rows, whatever their lengths, and which rows are valid.

    Null, empty and zero vectors, null and non-finite components are not valid.
    """
    rows = column.to_pylist()
    out, good = [], np.zeros(len(rows), bool)
    for i, row in enumerate(rows):
        if row and None not in row:
            values = np.array(row, np.float64)
            if np.isfinite(values).all():
                top = np.abs(values).max()
                if top > 0:
                    values = values / top
                    out.append(values / np.sqrt(values @ values))
                    good[i] = True
    return out, good


def _units(batches):
    for batch in batches:
        found, good = valid_units(batch.column("embedding"))
        keep = pa.array(good)
        raw = [np.ascontiguousarray(u + 0.0).tobytes() for u in found]
        keys = np.zeros((len(raw), 2), np.int64)
        for i, r in enumerate(raw):
            data = np.frombuffer(r, np.uint64)
            keys[i, 0] = W.runs(data, np.array([0]), np.array([len(data)])).view(np.int64)[0]
            keys[i, 1] = W.runs(W.mix(data), np.array([0]), np.array([len(data)])).view(np.int64)[0]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").filter(keep), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(raw, pa.binary())],
            ["vec_id", "key_a", "key_b", "unit"],
        )


def stacked(column) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float64).reshape(len(column), -1)


def choose_pivots(units: np.ndarray, most: int) -> np.ndarray:
    """Rows in their order, each unless it is too near to one taken before."""
    taken = units[:1]
    for row in units[1:]:
        if len(taken) == most:
            break
        if (taken @ row).max() < APART:
            taken = np.vstack([taken, row])
    return taken


def described(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first; ties go to the lower pivot."""
    return np.argsort(-np.round(units @ pivots.T, 12), axis=1, kind="stable")[:, :NEAREST]


def _lists(pivots: dict[int, np.ndarray]):
    def lists(batches):
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                part, base = batch.filter(pa.array(widths == width)), pivots[width]
                near = np.sort(described(stacked(part.column("unit")), base), axis=1)
                for group in combinations(range(min(NEAREST, len(base))), min(SHARED, len(base))):
                    keys = np.zeros(len(near), np.int64)
                    for place in group:
                        keys = keys * len(base) + near[:, place]
                    yield pa.RecordBatch.from_arrays([part.column("width"), pa.array(keys), part.column("vec_id")], ["width", "list", "vec_id"])

    return lists


def _forest(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked row and the smallest id of its component among these links."""
    least = ids.copy()
    while True:
        before = least.copy()
        np.minimum.at(least, left, before[right])
        np.minimum.at(least, right, before[left])
        if (least == before).all():
            break
    moved = np.flatnonzero(least != ids)
    return ids[moved], least[moved]


def _verify(every: dict[int, np.ndarray], cosine: float):
    def settle(group: pa.Table) -> pa.RecordBatch:
        pivots = every[group.column("width")[0].as_py()]
        size = min(SHARED, len(pivots))
        ids, own, copies = (group.column(c).to_numpy() for c in ("vec_id", "own", "copies"))
        low, high, key = (group.column(c)[0].as_py() for c in ("low", "high", "list"))
        units = stacked(group.column("unit"))
        member = np.zeros((len(ids), len(pivots)), bool)
        np.put_along_axis(member, described(units, pivots), True, axis=1)
        named = []
        for _ in range(size):
            key, place = divmod(key, len(pivots))
            named.append(place)
        rest = np.ones(len(pivots), bool)
        rest[max(named) + 1 :] = False
        rest[named] = False  # a pivot below the last named one that both have puts the pair in an earlier list
        earlier = member[:, rest].astype(np.float32)
        a, b = np.flatnonzero(own == low), np.flatnonzero(own == high)
        left, right = [], []
        for at in range(0, len(a), 512):
            rows = a[at : at + 512]
            near = (units[rows] @ units[b].T >= cosine) & (earlier[rows] @ earlier[b].T == 0)
            if low == high:
                near &= ids[rows][:, None] < ids[b][None, :]
            x, y = np.nonzero(near)
            left.append(rows[x])
            right.append(b[y])
        left, right = np.concatenate(left or [a[:0]]), np.concatenate(right or [a[:0]])
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        some = np.flatnonzero(links)
        roots = dict(zip(*(v.tolist() for v in _forest(ids, left, right))))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(links[some]), pa.array([roots.get(i, i) for i in ids[some].tolist()], pa.int64())],
            ["vec_id", "links", "root"],
        )

    names = ["width", "list", "low", "high"]

    def verify(batches):
        held: list[pa.Table] = []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            keys = np.column_stack([rows.column(c).to_numpy() for c in names])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if held and i == 0 and [held[0].column(c)[0].as_py() for c in names] != keys[0].tolist():
                    yield settle(pa.concat_tables(held))
                    held = []
                held.append(rows.slice(i, j - i))
                if j < len(keys):
                    yield settle(pa.concat_tables(held))
                    held = []
        if held:
            yield settle(pa.concat_tables(held))

    return verify


def near_vectors(vectors: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are
    kept. Equal vectors link with each other. No rows give no rows; vec_id must be unique; other
    columns, labels too, are never read.
    """
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = stored(vectors.mapInArrow(_units, "vec_id long, key_a long, key_b long, unit binary"), "units")
    classes = stored(
        units.groupBy("key_a", "key_b").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")), "classes"
    )
    firsts = classes.select(F.col("first").alias("vec_id"), "copies")
    distinct = stored(units.join(firsts, "vec_id").select("vec_id", "copies", "unit", (F.length("unit") / 8).cast("int").alias("width")), "distinct")
    # The lengths of two different vectors or more; others link with their copies only.
    widths = [r[0] for r in distinct.groupBy("width").agg(F.count("*").alias("n")).where("n > 1").orderBy("width").select("width").collect()]
    base = {}
    for width in widths:
        drawn = distinct.where(F.col("width") == width).orderBy(F.xxhash64("unit"), "vec_id").limit(SAMPLE).select("unit").collect()
        base[width] = choose_pivots(np.stack([np.frombuffer(r[0], np.float64) for r in drawn]), pivots)
    same = distinct.where(F.col("width").isin(widths))
    listed = same.select("width", "vec_id", "unit").mapInArrow(_lists(base), "width int, list long, vec_id long")
    lengths = listed.groupBy("width", "list").agg(F.count("*").alias("n")).where("n > 1")
    blocks = lengths.select("width", "list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = listed.join(blocks, ["width", "list"]).withColumn("own", F.pmod(F.hash("vec_id"), "blocks"))
    dealt = placed.select("list", "vec_id", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "list", "vec_id", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    key = ["width", "list", "low", "high"]
    work = dealt.join(same, "vec_id").repartition(*key).sortWithinPartitions(*key)
    work = work.select(*key, "own", "vec_id", "copies", "unit")
    found = stored(work.mapInArrow(_verify(base, cosine), "vec_id long, links long, root long"), "links")
    parts = components(found.where("vec_id <> root").select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    told = classes.join(counts.withColumnRenamed("vec_id", "first"), "first", "left").join(
        parts.withColumnRenamed("node", "first"), "first", "left"
    )
    told = told.select(
        "key_a", "key_b", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "first").alias("component_id"),
    )
    linked = units.select("vec_id", "key_a", "key_b").join(told, ["key_a", "key_b"]).select("vec_id", "n_links", "component_id")
    return vectors.select("vec_id").join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
