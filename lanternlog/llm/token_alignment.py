"""Alignment of two tokenizers' tokens by the bytes they cover, and corpus-wide counts of linked ids.

A text is cut where tokens of A and of B end at the same byte; what lies between is a group, whose A
and B tokens are all linked. Most groups hold one token of each with the same bytes: an array A id ->
B id of equal bytes knows them beforehand, so their documents are counted in a vector of the
vocabulary's length in each task. Only pairs of other groups enter the shuffle, counted before it.
Frequent pairs (at most ``HOT_PAIRS`` by their share of all rows) go back to the documents by a
broadcast, the others by a join on the pair, where no key holds more than that share.

Neither tokenizer merges over the start of white space or the end of a Latin word, so a text's tokens
are those of its units (white space with the word behind it, or what follows a word); units repeat,
and each worker keeps a bounded memory of them. Texts with rare white space are one unit.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch
from .tokens import vocabulary_path

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
MEMORY_UNITS, UNIT_CHARS, BLOCK_CHARS, HOT_PAIRS, LARGE_GROUP = 600_000, 64, 1_000_000, 100_000, 1024
SPACE = "\u2581"
#: Letters and marks of ASCII and Latin that both tokenizers tell apart; a word and the mark behind it are units of their own.
LETTERS, MARKS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-/:-@\[-`{-~"
UNITS = re.compile(rf"[ \t\n]*[{LETTERS}]+(?=[{MARKS}])|[ \t\n]*[^ \t\n]+|[ \t\n]+")
#: White space that the cut at units can't be sure of: of one tokenizer only, or inside pieces.
RARE = re.compile(r"[\x0b-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
WORD = re.compile(rf" [{LETTERS}]+")


#: What a stretch of text holds, in fixed-width bytes, so a document's are those of its units joined: numbers of A tokens, B tokens,
#: groups and links (int64 each); the groups as text; int32 A id of each link with that id's own B id; int64 A id << 32 | B id
#: of each other link; (pair, times) for very large groups.
Unit = tuple[bytes, str, bytes, bytes, tuple[tuple[int, int], ...]]


class Aligner(dict):
    """unit -> ``Unit``, or None where a tokenizer's bytes aren't those of the text."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        super().__init__()
        self.a, self.b = Tokenizer.from_file(vocabulary_path(a)), SentencePieceProcessor(model_file=vocabulary_path(b))
        self.a.encode_special_tokens = True
        self.model = self.a.model
        # Byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.alphabet = {x: x if x in kept else next(others) for x in range(256)}
        byte_of = {chr(c): x for x, c in self.alphabet.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        sp = self.b
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(map(sp.id_to_piece, range(sp.get_piece_size())))]
        plain = [i for i in range(len(self.b_bytes)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(re.search(rf"[^ \t\n][ \t\n]|[{LETTERS}][{MARKS}]|\n.", self.b_bytes[i].decode(), re.DOTALL) for i in plain):
            raise ValueError("pieces of B must not reach over the start of white space or the end of a word")
        of_b = {**{p: i for i, p in enumerate(self.b_bytes) if sp.is_byte(i)}, **{self.b_bytes[i]: i for i in reversed(plain)}}
        #: B id of the same bytes for each A id, -1 without one.
        self.same = np.array([of_b.get(p, -1) for p in self.a_bytes], np.int64)
        self.space = sp.piece_to_id(SPACE)
        self.a_width, self.b_width = (np.array([len(p) for p in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.marked = [f"{i}{m}" for ids, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for i in range(ids) for m in marks]

    def a_ids(self, unit: str) -> list[int]:
        if WORD.fullmatch(unit):  # one piece for the tokenizer's rules, so its model is asked directly
            spelt = "\u0120" + unit[1:] if unit.isascii() else unit.encode().decode("latin-1").translate(self.alphabet)
            return [t.id for t in self.model.tokenize(spelt)]
        return self.a.encode(unit, add_special_tokens=False).ids

    def b_ids(self, units: list[str]) -> Iterator[list[int]]:
        """B's ids of stretches of text; B itself puts a space before what it is given, and no piece goes on behind a line's end."""
        given = [u[1:] if u[0] == " " else "\n" + u for u in units]
        for u, ids in zip(units, self.b.encode(given, num_threads=1), strict=True):
            yield ids[2:] if u[0] != " " else ids if u != " " else [self.space]

    def learn(self, units: list[str]) -> None:
        """Align stretches of text, all at once."""
        known = []
        for u, x, y in zip(units, map(self.a_ids, units), self.b_ids(units), strict=True):
            if b"".join([self.a_bytes[i] for i in x]) == (raw := u.encode()) == b"".join([self.b_bytes[i] for i in y]):
                known.append((u, len(raw), x, y))
            else:
                self[u] = None
        if not known:
            return
        names, widths, of_a, of_b = zip(*known, strict=True)
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (of_a, of_b))
        ends_a, ends_b, unit_ends = np.cumsum(self.a_width[a]), np.cumsum(self.b_width[b]), np.cumsum(widths)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)  # ends of the groups
        in_a, in_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        per_a, per_b = np.bincount(in_a), np.bincount(in_b)
        # Links: each A token with all B tokens of its group; very large groups are counted apart.
        links = per_a * per_b
        large = links > LARGE_GROUP
        times = np.where(large, 0, per_b)[in_a]
        left = np.repeat(np.arange(len(a)), times)
        within = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        x, y = a[left], b[(np.cumsum(per_b) - per_b)[in_a[left]] + within]
        own = self.same[x] == y
        unit_of_link = np.searchsorted(unit_ends, ends_a[left])
        group_ends = np.searchsorted(cuts, unit_ends, "right")
        sizes = np.stack([np.fromiter(map(len, of_a), np.int64), np.fromiter(map(len, of_b), np.int64), np.diff(group_ends, prepend=0), np.diff(np.cumsum(links)[group_ends - 1], prepend=0)], 1)

        def cut(values: np.ndarray, chosen: np.ndarray) -> Iterator[bytes]:
            raw, width = values[chosen].tobytes(), values.dtype.itemsize
            stops = np.cumsum(np.bincount(unit_of_link[chosen], minlength=len(names))) * width
            return map(lambda i, j: raw[i:j], [0, *stops[:-1].tolist()], stops.tolist())

        # Groups as text: A's tokens of a group, then B's, each with the mark behind it.
        last_a, last_b = np.diff(in_a, append=-1) != 0, np.diff(in_b, append=-1) != 0
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        marked = np.concatenate([2 * a + last_a, 2 * (len(self.a_bytes) + b) + last_b])[order]
        words, stops = [self.marked[i] for i in marked.tolist()], np.cumsum(sizes[:, 0] + sizes[:, 1]).tolist()
        many: dict[int, Counter] = {}
        for g in np.flatnonzero(large).tolist():
            theirs, of_unit = Counter(b[in_b == g].tolist()), many.setdefault(int(np.searchsorted(unit_ends, cuts[g])), Counter())
            for i, m in Counter(a[in_a == g].tolist()).items():
                for k, n in theirs.items():
                    of_unit[i << 32 | k] += m * n
        rows = zip(names, sizes, [0, *stops], stops, cut(x.astype(np.int32), own), cut(x << 32 | y, ~own), strict=False)
        for k, (u, size, i, j, direct, others) in enumerate(rows):
            self[u] = (size.tobytes(), "".join(words[i:j])[:-1], direct, others, tuple(many[k].items()) if k in many else ())

    def documents(self, texts: list[str | None]) -> Iterator[list[Unit] | None]:
        """The units of space + text in order, or None if it has no tokens."""
        cut = [[" " + t] if t and RARE.search(t) else UNITS.findall(" " + t) if t else None for t in texts]
        new = [u for u in set(chain.from_iterable(filter(None, cut))) if u not in self]
        if len(self) + len(new) > MEMORY_UNITS:
            self.clear()
            new = list(set(chain.from_iterable(filter(None, cut))))
        self.learn(new)
        for units in cut:
            found = list(map(self.get, units or [None]))
            yield None if None in found else found
        for u in new:
            if len(u) > UNIT_CHARS:
                del self[u]


@cache
def aligner(a: str, b: str) -> Aligner:
    """One a worker, over all its tasks."""
    return Aligner(a, b)


SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " direct array<int>, direct_times array<long>, others array<long>, others_times array<long>"
)


def encoded(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row per document, and at the end of each task one with n_a null: ``direct`` ids and in how many of its documents each is."""
    names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units_of = aligner(a, b)
        vector = np.zeros(len(units_of.a_bytes), np.int64)
        types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int32())] + [pa.list_(pa.int64())] * 3

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Slices of at most ``BLOCK_CHARS`` bytes of text, or one text."""
            size, start = 0, 0
            for k, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                size += n or 0
                if size > BLOCK_CHARS and k > start:
                    yield batch.slice(start, k - start)
                    size, start = n or 0, k
            yield batch.slice(start)

        for block in chain.from_iterable(map(blocks, batches)):
            out = []
            for doc_id, units in zip(block.column(0).to_pylist(), units_of.documents(block.column(1).to_pylist()), strict=True):
                if units is None:
                    out.append((doc_id, 0, 0, 0, 0, "", [], [], [], []))
                    continue
                sizes, groups, direct, others, many = zip(*units, strict=True)
                n = np.frombuffer(b"".join(sizes), np.int64).reshape(-1, 4).sum(0).tolist()
                of_a, of_pair = Counter(np.frombuffer(b"".join(direct), np.int32).tolist()), Counter(np.frombuffer(b"".join(others), np.int64).tolist())
                for pair, times in chain.from_iterable(many):
                    if units_of.same[pair >> 32] == pair & 0xFFFFFFFF:
                        of_a[pair >> 32] += times
                    else:
                        of_pair[pair] += times
                vector[list(of_a)] += 1
                out.append((doc_id, *n, sha256(";".join(groups).encode()).hexdigest(), list(of_a), list(of_a.values()), list(of_pair), list(of_pair.values())))
            if out:
                yield rows(out)
        met = np.flatnonzero(vector)
        yield rows([(None, None, None, None, None, None, met.tolist(), vector[met].tolist(), [], [])])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def align(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    An id pair's count is the number of documents that hold it linked; ``n_best`` are the links whose
    count is the highest of their A id (ties included), ``count_sum`` adds the counts of all links.
    Null and empty texts, and those whose tokens' bytes differ from space + text, have no tokens: zeros
    and an empty digest. Rows that repeat are documents each, a null doc_id stays null, texts are read
    whole, an empty table gives an empty result; other columns are ignored.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(aligned(docs, a, b, hot_pairs), "aligned")


def aligned(docs: DataFrame, a: str, b: str, hot_pairs: int) -> DataFrame:
    stored = materialize(encoded(docs, a, b).withColumn("row", F.monotonically_increasing_id()), "encoded", "zstd")
    texts = stored.where("n_a is not null")

    def listed(rows: DataFrame, keys: str, values: str) -> DataFrame:
        return rows.select("row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(values).alias("times"))).alias("x")).select("row", "x.*")

    # One row per A id: bounded by the vocabulary.
    direct = materialize(listed(stored.where("n_a is null"), "direct", "direct_times").groupBy("key").agg(F.sum("times").alias("n")), "direct")
    pairs = materialize(texts.select(F.explode("others").alias("key")).groupBy("key").agg(F.count("*").alias("n")), "pairs")
    tops = pairs.select(F.shiftright("key", 32).alias("a"), "n").unionByName(direct.select(F.col("key").cast("long").alias("a"), "n"))
    tops = materialize(tops.groupBy("a").agg(F.max("n").alias("top")), "tops")

    def marked(counts: DataFrame, a_id) -> DataFrame:
        return counts.join(F.broadcast(tops), a_id == F.col("a")).select("key", "n", (F.col("n") == F.col("top")).alias("best"))

    # Counts add up to the rows, so at most hot_pairs of them exceed this share.
    share = (pairs.agg(F.sum("n")).first()[0] or 0) / hot_pairs
    pairs = materialize(marked(pairs, F.shiftright("key", 32)), "marked")
    hot = F.broadcast(pairs.where(F.col("n") > share))
    links = listed(texts, "others", "others_times")
    found = [
        listed(texts, "direct", "direct_times").join(F.broadcast(marked(direct, F.col("key").cast("long"))), "key"),
        links.join(hot, "key"),
        links.join(hot.select("key"), "key", "left_anti").join(pairs.where(F.col("n") <= share), "key"),
    ]
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    parts = [f.groupBy("row").agg(*sums) for f in found]
    total = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = texts.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(total, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
