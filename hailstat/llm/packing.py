"""Mixture-controlled packing: deficit round-robin over source queues into sequences of one length.

Every source is a queue of token chunks in document order; a window gives each queue a quantum in
proportion to its target share. A queue sends a chunk once its saved-up quanta cover it, and what it has
not used carries over. While its queue lasts, a chunk that ends at token ``e`` of its source is therefore
sent in window ``ceil(e / quantum)``: the round is a formula of the running total, no state has to walk
through the windows, and deficits carry across windows and partitions exactly. Chunks are at most one
sequence long, so a source is never further from its share than one chunk.

The rounds make one order of all chunks, and sequences are cut from it every ``LENGTH`` tokens, so only
the last one can be short. Running totals are those of a range-sorted table: sums within a partition,
plus the sums of the partitions before it, of which there is one row per partition and source.
"""

from __future__ import annotations

import base64
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import documents, stored

LENGTH = 1024
WINDOW_SEQUENCES = 64
END = 0
VOCABULARY = "byte_bpe_50k"
# Where a cut before a single space could change how the text splits into words.
UNEVEN = "^ | $|[\\s\\pZ\\x{1c}-\\x{1f}\\x{85}] | [\\s\\pZ\\x{1c}-\\x{1f}\\x{85}]"


def vocabulary_path(suffix: str = "json") -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{VOCABULARY}.{suffix}")


class Tokens:
    """Token ids of texts as the vocabulary's own tokenizer gives them.

    A text splits into words before merging, and a cut before a single space between two characters
    that are not white space never lies inside a word. So distinct space-led pieces of a chunk are encoded
    once, joined in one text, and looked up; texts with other white space around a space are encoded whole.
    """

    def __init__(self, ranks: str, full: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.spaced = np.zeros(1 << 17, bool)
        self.spaced[[i for token, i in self.ranks.items() if token[:1] == b" "]] = True
        self.full = full

    @cache  # noqa: B019  one object per process
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.full)

    def encode(self, text: str) -> np.ndarray:
        if "<|" in text:  # may be the text of a special token
            return np.array(self.whole().encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.coder.encode_ordinary(text), np.int64)

    def rows(self, column: pa.Array) -> list[np.ndarray]:
        column = pc.fill_null(column, "")
        odd = pc.or_(pc.match_substring_regex(column, UNEVEN), pc.match_substring(column, "<|"))
        odd = pc.or_(odd, pc.equal(pc.binary_length(column), 0)).to_numpy(zero_copy_only=False)
        out: list = [None] * len(column)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.encode(column[i].as_py())
        even = np.flatnonzero(~odd)
        if len(even):
            lists = pc.split_pattern(column.take(pa.array(even)), " ")
            first = lists.offsets.to_numpy()
            coded = lists.flatten().dictionary_encode()
            index, distinct = coded.indices.to_numpy(), coded.dictionary
            ids = np.array(self.coder.encode_ordinary(" " + " ".join(distinct.to_pylist())), np.int64)
            cuts = np.append(np.flatnonzero(self.spaced[ids]), len(ids))
            lengths = np.diff(cuts)
            heads = [self.coder.encode_ordinary(distinct[k].as_py()) for k in index[first[:-1] - first[0]].tolist()]
            index_lengths, index_starts = lengths[index], cuts[:-1][index]
            for j, i in enumerate(even.tolist()):
                a, b = first[j] - first[0] + 1, first[j + 1] - first[0]
                rest = ids[W.gather(index_lengths[a:b], index_starts[a:b])]
                out[i] = np.concatenate([np.array(heads[j], np.int64), rest])
        return out


@cache
def _tokens(ranks: str, full: str) -> Tokens:
    return Tokens(ranks, full)


def _encode(ranks: str, full: str):
    def encode(batches):
        coder = _tokens(ranks, full)
        for part in W.chunks(batches, limit=6 << 20):
            rows = coder.rows(part.column("text"))
            packed = [np.append(r, END).astype("<u2" if len(r) == 0 or r.max() < 65536 else "<u4") for r in rows]
            wide = [p.dtype.itemsize for p in packed]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("source"), pa.array([len(p) for p in packed], pa.int64()),
                 pa.array(wide, pa.int32()), pa.array([p.tobytes() for p in packed], pa.binary())],
                ["doc_id", "source", "doc_tokens", "width", "ids"],
            )

    return encode


def running(df: DataFrame, size: str, order: list[str], group: list[str]) -> DataFrame:
    """``df`` with ``before``: the sum of ``size`` over the rows of its group that come earlier in the order.

    The order must begin with the group. One range-sorted pass; only the partitions' sums are added up,
    of which there is one row for each partition and group in it.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged.mapInArrow(_inner(size, group), _with(ranged, "inner long")), "running")
    sums = ranged.groupBy("part", *group).agg(F.sum(size).alias("whole"))
    earlier = Window.partitionBy(*group, *([] if group else [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", *[F.col(g).alias(f"of_{g}") for g in group], F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("base"))
    meet = [ranged["part"] == sums["part"], *[ranged[g].eqNullSafe(sums[f"of_{g}"]) for g in group]]
    joined = ranged.join(sums, meet, "left")
    return joined.select(*df.columns, (F.col("inner") + F.col("base")).alias("before"))


def _with(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), more])


def _inner(size: str, group: list[str]):
    """Adds the sum of the earlier rows of the partition, and of the group where there is one."""

    def inner(batches):
        total, current = 0, ()
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(size).to_numpy()
            ends = np.cumsum(values)
            sums = ends - values
            if not group:
                sums, total = sums + total, total + int(ends[-1])
            else:
                keys = list(zip(*(batch.column(g).to_pylist() for g in group)))
                opens = [i for i in range(len(keys)) if keys[i] != (keys[i - 1] if i else current)]
                base = np.full(len(keys), total)
                for i, j in zip(opens, [*opens[1:], len(keys)]):
                    base[i:j] = -sums[i]
                sums = sums + base
                total, current = int(sums[-1] + values[-1]), keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], [*batch.schema.names, "inner"])

    return inner


def _checks(batches):
    """The pieces of each document in order, with the checksum of their ids."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
    for batch in batches:
        out = {n: [] for n in names}
        for row in batch.to_pylist():
            data, width = row["ids"], row["width"]
            wide = data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()
            for start, length, sequence, offset in row["pieces"] and [tuple(p.values()) for p in row["pieces"]]:
                piece = wide[4 * start : 4 * (start + length)]
                for n, v in zip(names, (row["doc_id"], start, length, zlib.crc32(piece), row["doc_tokens"], sequence, offset, row["source"])):
                    out[n].append(v)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(out[n], pa.int64()) for n in names[:-1]), pa.array(out["source"], pa.string())], names
        )


def encoded(docs: DataFrame, ranks: str | None = None, full: str | None = None) -> DataFrame:
    """``doc_id, source, doc_tokens, width, ids``: the ids of each text and then id 0, little-endian, ``width`` bytes each."""
    columns = documents(docs, F.col("source").cast("string").alias("source"))
    work = _encode(ranks or vocabulary_path("tiktoken"), full or vocabulary_path())
    return columns.mapInArrow(work, "doc_id long, source string, doc_tokens long, width int, ids binary")


def pack(docs: DataFrame, shares: dict[str, float] | None = None, ranks: str | None = None, full: str | None = None) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source`` of all documents.

    ``shares`` are target token weights per source; a source without one weighs its own share of all
    tokens (so by default every window has the proportions of the corpus and all queues end together).
    A source whose queue is empty leaves its room to the others. Null and empty texts are the id 0 alone;
    a null source is a source; no rows give no pieces. Rows stand for themselves: equal texts, and rows with the same
    doc_id or none, are packed each, under a number of their own.
    """
    tokens = stored(encoded(docs, ranks, full).withColumn("row", F.monotonically_increasing_id()), "tokens")
    sizes = tokens.select("row", "doc_id", "source", "doc_tokens")
    queues = running(sizes, "doc_tokens", ["source", "doc_id", "row"], ["source"])
    totals = sizes.groupBy("source").agg(F.sum("doc_tokens").alias("source_tokens"))
    whole = sizes.agg(F.sum("doc_tokens")).first()[0] or 1
    weight = F.col("source_tokens") / F.lit(whole)
    for name, share in (shares or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(share))).otherwise(weight)
    quanta = totals.select(F.col("source").alias("queue"), (weight * LENGTH * WINDOW_SEQUENCES).alias("quantum"))
    chunks = queues.join(quanta, queues["source"].eqNullSafe(quanta["queue"])).select(
        "row", "doc_id", "source", "before", "quantum",
        F.explode(F.expr(f"transform(sequence(0, (doc_tokens - 1) div {LENGTH}), i -> "
                         f"named_struct('start', i * {LENGTH}, 'length', least({LENGTH}, doc_tokens - i * {LENGTH})))")).alias("chunk"),
    )
    rounds = chunks.select(
        F.ceil((F.col("before") + F.col("chunk.start") + F.col("chunk.length")) / F.col("quantum")).alias("round"),
        "source", "doc_id", "row", F.col("chunk.start").alias("start"), F.col("chunk.length").alias("length"),
    )
    ordered = running(rounds, "length", ["round", "source", "doc_id", "row", "start"], [])
    cut = f"least({LENGTH} - before % {LENGTH}, length)"
    pieces = ordered.selectExpr(
        "row",
        f"""inline(filter(array(
            struct(start, {cut} AS length, before div {LENGTH} AS sequence_id, before % {LENGTH} AS offset),
            struct(start + {cut} AS start, length - {cut} AS length, before div {LENGTH} + 1 AS sequence_id, 0L AS offset)
        ), p -> p.length > 0))""",
    )
    piece = F.struct(*(F.col(c).cast("long").alias(c) for c in ("start", "length", "sequence_id", "offset")))
    lists = pieces.groupBy("row").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
    return tokens.join(lists, "row").select("doc_id", "source", "doc_tokens", "width", "ids", "pieces").mapInArrow(_checks, schema)
