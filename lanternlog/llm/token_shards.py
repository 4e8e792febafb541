"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

Documents follow each other, each closed by the end id, and are cut every ``length`` ids. They follow
each other as they lie in the tasks that read them, so the sequences hang on the input's splits, and a
task's last one is padded; with ``repeatable`` they follow each other by doc_id and text over the whole table,
so the same documents give the same sequences and slots on any cluster, for one move of the ids more. Every sequence has an index from 0 to N-1. A Feistel network keyed
with ``seed`` permutes the next power of four; walking its cycles until a value below N is met
permutes 0..N-1 itself. The result is the sequence's global slot: step k of a training run reads
slot k, whatever the cluster. Range partitions of slots write shards of ``shard_slots`` sequences;
slot s lies in shard s // shard_slots at byte (s % shard_slots) * stride, so a reader resumes by
arithmetic alone.

The texts are tokenised once. Sequences are compressed for the way between, and what lies there goes
once the shards are written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import checked_broadcast, materialize, scratch, scratch_root, text_hash
from .packing import END_ID
from .tokens import DEFAULT_VOCABULARY, worker_tokenizer

LENGTH, SHARD_SLOTS, PAD_ID, ROUNDS = 1024, 4096, 0, 6
#: Units a worker remembers over its tasks, about 160 bytes each.
REMEMBERED = 900_000
PIECE = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, offset: bigint, ids_crc32: bigint>"


def feistel(index: np.ndarray, n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of 0..n-1 chosen by ``seed``, at the given indexes."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(rounds):
            with np.errstate(over="ignore"):
                mixed = right + np.uint64((seed * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & (1 << 64) - 1)
                mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                mixed ^= mixed >> np.uint64(31)
            left, right = right, left ^ (mixed & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= np.uint64(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def file_system(path: str):
    """(file system, path there): shared mounts, HDFS and object stores alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def sequences(docs: DataFrame, length: int, vocabulary: str) -> DataFrame:
    """(task, at, ids: little-endian uint16, pieces: what lies in it), one row per sequence."""
    from pyspark import TaskContext

    end = np.array([END_ID], dtype="<u2").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task, at = worker_tokenizer(vocabulary, REMEMBERED), TaskContext.get().partitionId(), 0
        held, pieces, full, lists = bytearray(), [], [], []

        def rows() -> pa.RecordBatch:
            nonlocal at, full, lists
            flat = list(zip(*(p for one in lists for p in one), strict=True)) or [[]] * 6
            types = (pa.int64(), pa.int32(), *[pa.int64()] * 4)
            struct = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(flat, types, strict=True)], ["doc_id", "piece", "start", "length", "offset", "ids_crc32"])
            offsets = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
            places = [pa.array(np.full(len(full), task, np.int64)), pa.array(np.arange(at, at + len(full))), pa.array(full, pa.binary())]
            at, full, lists = at + len(full), [], []
            return pa.RecordBatch.from_arrays([*places, pa.ListArray.from_arrays(offsets, struct)], ["task", "at", "ids", "pieces"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.ids(batch.column(1).to_pylist()), strict=True):
                ids, done, piece = ids + end, 0, 0
                while done < len(ids):
                    part = ids[done : done + 2 * length - len(held)]
                    pieces.append((doc_id, piece, done // 2, len(part) // 2, len(held) // 2, crc(np.frombuffer(part, "<u2"))))
                    held += part
                    done, piece = done + len(part), piece + 1
                    if len(held) == 2 * length:
                        full.append(bytes(held))
                        lists.append(pieces)
                        held, pieces = bytearray(), []
            if len(full) >= 1024:
                yield rows()
        if held:
            full.append(bytes(held))
            lists.append(pieces)
        if full:
            yield rows()

    schema = f"task long, at long, ids binary, pieces array<{PIECE}>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def with_slots(stored: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """(slot, ids: zstd, bytes: their size, pieces) of ``stored`` with the global slot of each sequence, and their number."""
    tasks = materialize(stored.groupBy("task").agg(F.count("*").alias("n")), "tasks")  # one row per input split
    n = tasks.agg(F.sum("n")).first()[0] or 0
    first = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("first"))

    @F.pandas_udf("long")
    def slot(index: pd.Series) -> pd.Series:
        return pd.Series(feistel(index.to_numpy(), n, seed) if len(index) else [], dtype="int64")

    @F.pandas_udf("binary")
    def packed(ids: pd.Series) -> pd.Series:
        codec = pa.Codec("zstd", compression_level=6)
        return ids.map(lambda x: codec.compress(x, asbytes=True))

    placed = stored.join(checked_broadcast(materialize(first, "first")), "task")
    return placed.select(slot(F.col("first") + F.col("at")).alias("slot"), packed("ids").alias("ids"), F.octet_length("ids").alias("bytes"), "pieces"), n


def ordered_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(part, start, doc_id, ids): documents by doc_id and text in ranges, with the number of ids before them in their range."""
    end = np.array([END_ID], dtype="<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(vocabulary, REMEMBERED)
        for b in batches:
            ids = [x + end for x in tokenizer.ids(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], ["doc_id", "key", "ids"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            sizes = pc.binary_length(b.column("ids")).to_numpy().astype(np.int64) // 2
            starts = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(starts), b.column("doc_id"), b.column("ids")], ["part", "start", "doc_id", "ids"])

    given = docs.select(F.col("doc_id").cast("long"), text_hash().alias("key"), F.col("text").cast("string"))
    ranged = given.mapInArrow(encode, "doc_id long, key string, ids binary").repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    return ranged.withColumn("part", F.spark_partition_id()).mapInArrow(count, "part int, start long, doc_id long, ids binary")


def ordered_pieces(stored: DataFrame, length: int, seed: int) -> tuple[DataFrame, int]:
    """(slot, ids, piece) of each document's part in a sequence, of ``ordered_ids``, and the number of sequences."""
    sizes = materialize(stored.groupBy("part").agg(F.max(F.col("start") + F.octet_length("ids") / 2).cast("long").alias("size")), "sizes")  # one row a range
    ids = sizes.agg(F.sum("size")).first()[0] or 0
    n = -(-ids // length)
    first = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("first"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, at, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "ids")), strict=True):
                done, piece, size = 0, 0, len(raw) // 2
                while done < size:
                    index, offset = divmod(at + done, length)
                    many = min(length - offset, size - done)
                    part = raw[2 * done : 2 * (done + many)]
                    rows.append((index, part, doc_id, piece, done, many, offset, crc(np.frombuffer(part, "<u2"))))
                    done, piece = done + many, piece + 1
            if rows:
                index, parts, *piece = zip(*rows, strict=True)
                types = (pa.int64(), pa.int32(), *[pa.int64()] * 4)
                struct = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(piece, types, strict=True)], ["doc_id", "piece", "start", "length", "offset", "ids_crc32"])
                slots = feistel(np.array(index, np.int64), n, seed)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(parts, pa.binary()), struct], ["slot", "ids", "piece"])

    placed = stored.join(checked_broadcast(materialize(first, "first")), "part").select("doc_id", (F.col("first") + F.col("start")).alias("start"), "ids")
    return placed.mapInArrow(cut, f"slot long, ids binary, piece {PIECE}"), n


def whole_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one slot (slot, shard, ids, piece), which follow each other by their offsets, as one (slot, shard, ids: zstd, bytes, pieces)."""
    codec, rows = pa.Codec("zstd"), []
    slot, shard, held, pieces = None, None, bytearray(), []

    def batch() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), *((c, pa.int64()) for c in ("start", "length", "offset", "ids_crc32"))]))]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["slot", "shard", "ids", "bytes", "pieces"])
        rows.clear()
        return out

    for b in batches:
        for s, d, ids, piece in zip(*(b.column(c).to_pylist() for c in ("slot", "shard", "ids", "piece")), strict=True):
            if s != slot and held:
                rows.append((slot, shard, codec.compress(bytes(held), asbytes=True), len(held), pieces))
                held, pieces = bytearray(), []
                if len(rows) >= 1024:
                    yield batch()
            slot, shard = s, d
            held += ids
            pieces.append(piece)
    if held:
        rows.append((slot, shard, codec.compress(bytes(held), asbytes=True), len(held), pieces))
    if rows:
        yield batch()


def write_shards(
    docs: DataFrame, path: str, seed: int, length: int = LENGTH, shard_slots: int = SHARD_SLOTS, vocabulary: str = DEFAULT_VOCABULARY, repeatable: bool = False
) -> DataFrame:
    """Write all sequences of ``docs`` to ``path`` and return where each piece of a document went.

    A row per piece, which is a document or its part in one sequence: doc_id, piece, start and
    length in the document's ids, slot, shard, byte_offset of its first id in the shard, ids_crc32
    (of its ids as uint32). The files are ``shard-<number>.u16``. A task writes under names of its
    own in ``_open`` and renames at the end, so a repeated or lost task leaves no broken shard;
    ``_open`` goes at the end. With ``repeatable`` the order of the documents, and so every slot, hangs on the table's
    rows alone. Shards are written once, here; reading the result writes nothing.
    A null or empty text is the end id alone, a text of any length is cut where a sequence ends,
    rows that repeat a doc_id are documents each, other columns are ignored; an empty table writes nothing.
    """
    spark = docs.sparkSession
    with scratch(spark) as keep:
        if repeatable:
            placed, n = ordered_pieces(materialize(ordered_ids(docs, vocabulary), "ordered", "zstd"), length, seed)
        else:
            placed, n = with_slots(materialize(sequences(docs, length, vocabulary), "sequences", "zstd"), seed)
        shards = max(1, -(-n // shard_slots))
        parts, shard = min(shards, 4096), F.floor(F.col("slot") / shard_slots)
        # Ranges of slots: a shard lies within one task, neighbours lie together.
        ordered = placed.withColumn("shard", shard).repartitionById(parts, F.floor(F.col("shard") * parts / shards).cast("int")).sortWithinPartitions(*(["slot", "piece.offset"] if repeatable else ["slot"]))
        write = shard_writer(path, length)
        written = keep(ordered.mapInArrow((lambda batches: write(whole_sequences(batches))) if repeatable else write, f"slot long, shard long, pieces array<{PIECE}>"), "places")
    if n:
        system, root = file_system(path)
        system.delete_dir(f"{root}/_open")
    piece = written.select("slot", "shard", F.explode("pieces").alias("p"))
    at = F.pmod("slot", F.lit(shard_slots)) * (2 * length) + 2 * F.col("p.offset")
    return piece.select("p.doc_id", "p.piece", "p.start", "p.length", "slot", "shard", at.alias("byte_offset"), "p.ids_crc32")


def shard_writer(path: str, length: int):
    """Writes the rows of a partition (slot, shard, ids, bytes, pieces), sorted by slot, to one file a shard."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, tag, stride = pa.Codec("zstd"), uuid.uuid4().hex, 2 * length
        system, root = file_system(path)
        system.create_dir(f"{root}/_open", recursive=True)
        out, open_shard = None, -1

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                out = None
                system.move(f"{root}/_open/{open_shard:08d}.{tag}", f"{root}/shard-{open_shard:08d}.u16")

        for b in batches:
            for shard, ids, size in zip(b.column("shard").to_pylist(), b.column("ids"), b.column("bytes").to_pylist(), strict=True):
                if shard != open_shard:
                    close()
                    open_shard, out = shard, system.open_output_stream(f"{root}/_open/{shard:08d}.{tag}")
                out.write(codec.decompress(ids.as_buffer(), size, asbytes=True).ljust(stride, b"\0"))
            yield b.select(["slot", "shard", "pieces"])
        close()

    return write


def read_slots(path: str, first: int, count: int, length: int = LENGTH, shard_slots: int = SHARD_SLOTS) -> Iterator[np.ndarray]:
    """Sequences of the slots from ``first`` on, in order, padded: what a resumed trainer reads."""
    system, root = file_system(path)
    stride, slot = 2 * length, first
    while slot < first + count:
        shard, at = divmod(slot, shard_slots)
        many = min(first + count - slot, shard_slots - at)
        with system.open_input_file(f"{root}/shard-{shard:08d}.u16") as f:
            f.seek(at * stride)
            block = np.frombuffer(f.read(many * stride), "<u2").reshape(-1, length)
        yield from block
        if len(block) < many:
            return
        slot += many


def shard_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/shards-{uuid.uuid4().hex}"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
