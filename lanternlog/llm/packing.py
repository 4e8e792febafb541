"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt over bounded packing
partitions; each runs best-fit decreasing and computes a lower bound on its bin count with
dual-feasible functions. A partition that meets its bound is certified and final. In the others
the full bins are final too, while the bins with a gap give their documents back: these are dealt
anew, so that documents of different partitions meet, and packed again. A partition never holds
more than about ``GROUP_PIECES`` pieces. Rounds end when everything is certified, when one
partition held all the rest, or when a round has saved no bin; then the places of the last
round stand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch
from .tokens import DEFAULT_VOCABULARY, UnitTokenizer

CAPACITY, END_ID = 4096, 1
#: Pieces that one packing task holds: a few dozen bytes each.
GROUP_PIECES = 40_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def document_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids (its tokens, then the end id): doc_id, piece, start, length, ids_crc32[, ids].

    A null or empty text is the end id alone. Only documents of over ``capacity`` ids are cut.
    A row is a document: rows that repeat a doc_id give their pieces each. ``ids`` are
    little-endian uint16. Other columns are ignored.
    """
    schema = PIECES + (", ids binary" if with_ids else "")
    end = np.array([END_ID], dtype="<u2").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = UnitTokenizer(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.ids(batch.column(1).to_pylist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 2 * capacity)):
                    part = ids[at : at + 2 * capacity]
                    rows.append((doc_id, piece, at // 2, len(part) // 2, zlib.crc32(np.frombuffer(part, "<u2").astype("<u4").tobytes()), *([part] if with_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Largest bound on the bins that ``lengths`` need, over two families of dual-feasible functions.

    Such a function gives each length a weight so that no bin holds more than 1 in all; the sum of weights,
    rounded up, is a bound. First family, for a threshold k up to half the capacity: lengths over
    capacity - k weigh 1, those under k nothing, the others their share (k = 0: all their share).
    Second, for p = 1, 2, ...: a length over i/(p+1) of the capacity weighs i/p, rounded down to
    that grid, but one that is a multiple of capacity/(p+1) keeps its share.
    """
    if not len(lengths):
        return 0
    ordered = np.sort(lengths)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    half = capacity // 2
    low, high = ordered[ordered <= half], ordered[ordered > capacity - half]
    k = np.unique(np.concatenate([[0, half], low, capacity - high + 1]))
    k = k[k <= half]
    first, large = np.searchsorted(ordered, k, "left"), np.searchsorted(ordered, capacity - k, "right")
    whole = len(ordered) - large
    middle = sums[large] - sums[np.minimum(first, large)]
    best = int((whole + -(-middle // capacity)).max())
    sizes, counts = np.unique(ordered, return_counts=True)
    for p in range(1, 65):
        steps, exact = sizes * (p + 1) // capacity, sizes * (p + 1) % capacity == 0
        # In units of 1 / (p * capacity), so that sums are whole numbers.
        weight = np.where(exact, sizes * p, steps * capacity)
        best = max(best, -(-int((weight * counts).sum()) // (p * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and the fill of each bin. The fullest bin that still fits gets the next largest."""
    order = np.argsort(-lengths, kind="stable")
    where, offset, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    gaps: dict[int, list[int]] = {}
    present = 0  # bit g: some bin has a gap of g
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = present >> length
        if fits:
            gap = length + (fits & -fits).bit_length() - 1
            bins = gaps[gap]
            b = bins.pop()
            if not bins:
                present ^= 1 << gap
        else:
            b, gap = len(fill), capacity
            fill.append(0)
        where[i], offset[i] = b, fill[b]
        fill[b] += length
        if gap := gap - length:
            rest = gaps.setdefault(gap, [])
            if not rest:
                present |= 1 << gap
            rest.append(b)
    return where, offset, np.array(fill, np.int64)


def group_packer(capacity: int, number: int, ends_at: float):
    """Packs one group's pieces; ``number`` and the group keep sequence ids of all rounds apart."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["_group"]).sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        lengths = rows.column("length").to_numpy()
        where, offset, fill = best_fit_decreasing(lengths, capacity)
        certified = len(fill) == lower_bound(lengths, capacity)
        final = np.full(len(where), True) if certified else fill[where] >= capacity * (1 - ends_at)
        # 8 bits round, 23 bits group, 32 bits bin.
        sequence = (number << 55) | (key[0].as_py() << 32) | where
        for name, values in (("sequence_id", sequence), ("offset", offset), ("certified", np.full(len(where), certified)), ("final", final)):
            rows = rows.append_column(name, pa.array(values))
        return rows

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, ends_at: float = 0.0, rounds: int = 8) -> DataFrame:
    """``pieces`` (with doc_id, piece, length) plus sequence_id, offset, certified, round.

    Every piece keeps its place once its bin is final; offsets are gapless from 0. Lengths must
    be 1 to ``capacity``. ``certified``: its partition's bin count met the lower bound.
    """
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long, certified boolean, final boolean"
    left, done, number, before = pieces, [], 0, None
    rest = left.count()
    while True:
        groups = max(1, -(-rest // group_pieces))
        dealt = left.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", F.lit(number)), F.lit(groups)))
        packed = materialize(dealt.groupBy("_group").applyInArrow(group_packer(capacity, number, ends_at), schema), f"packed{number}")
        shown = packed.drop("final").withColumn("round", F.lit(number))
        open_ = packed.where("not final")
        per_bin = packed.groupBy("sequence_id").agg(F.bool_or(~F.col("final")).alias("open"), F.count("*").alias("n"))
        bins, still_open, rest = per_bin.agg(F.count("*"), F.count_if("open"), F.sum(F.when(F.col("open"), F.col("n")))).first()
        if not rest or groups == 1 or number + 1 >= rounds or (before is not None and bins >= before):
            done.append(shown)
            break
        done.append(packed.where("final").drop("final").withColumn("round", F.lit(number)))
        left, before, number = open_.select(columns), still_open, number + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: a row per piece with its sequence and its place there.

    An empty table gives an empty result; ties in length go by doc_id and piece.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(pack(materialize(document_pieces(docs, capacity, vocabulary, with_ids), "pieces"), capacity), "packed")
