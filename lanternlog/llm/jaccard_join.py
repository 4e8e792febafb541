"""Exact n-gram Jaccard self-join by universe partitioning, reduced to connected groups.

A document is the set of its word shingles, as 64-bit values. Sets of similarity t differ in few
shingles: at most H = (1-t)/(1+t) * (|r|+|s|). Hashing deals the universe of shingles into m
segments; by pigeonhole two such sets agree on some segment, or differ there by one shingle only.
For each size band a plan is chosen by cost: many segments matched exactly, or half as many
matched exactly or after one deletion, each with g spare segments. Segments that are empty in
both sets prove nothing, so a set with more than g of them (rare by the choice of g) also emits
the shingles of its prefix: two such sets of similarity t share one of those. A set emits
signatures for its own band and, if it can be similar to a member of it, for the next.

Allocation also looks at the lists: similar sets agree on more than g segments, so a set whose
signatures with long lists (over ``LONG`` sets), together with its empty segments, are at most g
leaves those lists; only sets with more of them, such as members of large groups of near copies,
stay there. A passage that many documents share thus makes no long lists of unlike documents.

Sets that share a signature form a bucket; one shuffle of (signature, set) finds those of two or
more. A set has hundreds of signatures and each at most once, so even a signature that all sets have is
a small share of that shuffle. A candidate pair is first held against parity sketches, which grow
with the set (every shingle flips one bit, so sets never differ in fewer shingles than their
sketches in bits); what they can't rule out is verified on the shingles of both texts, which are
sent for such pairs only. Copies of a set are one class from the start.

Only connected groups are asked for, so buckets are not expanded into all pairs. Members are held
against the bucket's pivot first; buckets that are one group then are done. In the rest, rows
outside the largest group are held against their bucket in blocks of ``BLOCK`` rows. A block first
gives only a lightest spanning forest of the pairs that sketches let pass, so its rows are
linear in its members; once those are verified, all pairs still between different groups follow. Larger buckets take ``PIVOTS`` rows a
round; a row that has met its bucket leaves it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import checked_broadcast, drop_ids, materialize, scratch, text_hash

U = np.uint64
#: Sketch comparisons per bucket member up to which all rows that are left take their turn at once.
PAIRS_PER_MEMBER = 16_384
PIVOTS = 4096
#: Rows of a bucket whose sketches one task holds against another such block.
BLOCK = 4096
#: Bytes of sketches over ``WIDE`` bytes that such a block holds besides; a bucket of long texts has more blocks.
BLOCK_BYTES, WIDE = 8 << 20, 1024
#: Bits of the smallest sketch; larger sets have as many bits as shingles at least.
SKETCH_BITS = 512
#: Links that one task brings to stars.
PART_LINKS = 500_000
#: Candidate pairs that a task holds to report each once.
HELD = 500_000
#: Sets in a list from which on it is left by those that can do without.
LONG = 24


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; with fewer words, the whole sequence is one; no words, none."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()  # ASCII case and white space only
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(xxh3_64_intdigest, words), U, len(words))
    width = min(k, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        s = np.full(n, width, U)
        for i in range(width):
            s = mix(s * U(0x9E3779B97F4A7C15) + h[i : n + i])
    return np.unique(s)


def sketch(s: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; halves of a sketch add up to the sketch of half its size."""
    size = SKETCH_BITS
    while size < len(s):
        size *= 2
    bits = np.bincount((mix(s ^ U(0x1D8E4E27C47D124F)) & U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) brought down to ``words`` words each."""
    while (half := sketches.shape[1] // 2) >= words:
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def by_size(sketches: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, rows of 64-bit words) for the sketches of each size."""
    sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
    groups = [np.flatnonzero(sizes == size) for size in np.unique(sizes)]
    return [(at, np.frombuffer(b"".join([sketches[i] for i in at]), np.uint64).reshape(len(at), -1)) for at in groups]


def alike(n: np.ndarray, m: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles that differ in ``apart`` of them or more may have the asked similarity."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (apart * (100 + percent) <= (100 - percent) * (n + m))


class Bands:
    """Size bands for a similarity of ``percent``, and the plan of each."""

    def __init__(self, percent: int, steps: int):
        self.percent, self.steps, self.low = percent, steps, [1]

    def band(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(max(self.low[-1] + 1, math.ceil(self.low[-1] * (100 / self.percent) ** self.steps)))
        return int(np.searchsorted(self.low, n, "right")) - 1

    def bands_of(self, n: int) -> list[int]:
        own = self.band(n)
        return [own, own + 1] if 100 * n >= self.percent * self.low[own + 1] else [own]

    @lru_cache(maxsize=None)  # noqa: B019
    def plan(self, band: int) -> tuple[int, int, bool]:
        """(m segments, g spare ones, one-deletion neighbourhoods or not) of least expected cost."""
        self.band(self.low[-1])
        while len(self.low) < band + 2:
            self.band(self.low[-1])
        low, high, t = self.low[band], self.low[band + 1] - 1, self.percent
        differ = (100 - t) * 2 * high // (100 + t)
        size = max(1, -(-t * low // 100))  # the smallest set that emits for this band
        best = None
        for deletions in (False, True):
            need = -(-(differ + 1) // 2) if deletions else differ + 1
            for g in sorted({0, 1, 2, 3, 4, 6, 8, *(need * i // 40 for i in range(41))}):
                m = need + g
                mean = size / m
                weak = 0.0 if m == 1 and size > deletions else math.exp(-mean) * (1 + mean * deletions)
                expected = m * weak
                # Normal tail for the chance of too few spare segments for the weak ones and a tenth of long lists.
                sparse = 0.0 if need == 1 else 0.5 * math.erfc((g + 0.5 - expected - need / 10) / math.sqrt(2 * max(expected, 0.2)))
                cost = m * (1 - weak) + high * deletions + sparse * (high * (100 - t) / 100 + 1) * 8
                if best is None or cost < best[0]:
                    best = (cost, m, g, deletions)
        return best[1:]


def signatures(s: np.ndarray, bands: Bands) -> tuple[np.ndarray, int]:
    """Signatures of a set, and how many of them it can do without (-1: it is sparse and needs all).

    Two sets of the asked similarity share one at least, also after both left that many.
    """
    n, out, slack = len(s), [], 1 << 30
    if not n:
        return np.empty(0, np.int64), 0
    value = mix(s ^ U(0xA0761D6478BD642F))
    for band in bands.bands_of(n):
        m, g, deletions = bands.plan(band)
        segment = (((s >> U(32)) * U(m)) >> U(32)).astype(np.int64)  # follows the order of s
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        counts = np.diff(starts, append=n)
        with np.errstate(over="ignore"):
            salt = mix(U(band + 1) * U(0xE7037ED1A0B428DB) + segment[starts].astype(U) * U(0x8EBC6AF09C88C6E3))
            sums = np.add.reduceat(value, starts)
            out.append(mix(salt + sums + counts.astype(U)))
            if deletions:
                of = np.repeat(np.arange(len(starts)), counts)
                out.append(mix(salt[of] + sums[of] - value + (counts[of] - 1).astype(U)))
        slack = min(slack, g - (m - int((counts > deletions).sum())))
    if slack < 0:
        prefix = n - -(-bands.percent * n // 100) + 1
        out.append(mix(s[:prefix] ^ U(0x589965CC75374CC3)))
    return np.unique(np.concatenate(out)).view(np.int64), max(slack, -1)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, sketch), one row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, sketches = [], [], []
            for text in b.column(1):
                s = shingles(text.as_py(), k)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    digest.append(b"".join(int(mix(s + U(c)).sum()).to_bytes(8, "little") for c in (1, 2)) if len(s) else None)
                sketches.append(sketch(s))
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch binary")


def signature_rows(docs: DataFrame, k: int, percent: int, steps: int) -> DataFrame:
    """(sig, rep, slack) for every signature of every document of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, steps)

        def rows(sigs: list[np.ndarray], reps: list[int], slacks: list[int]) -> pa.RecordBatch:
            sizes = [len(x) for x in sigs]
            columns = [pa.array(np.concatenate(sigs)), pa.array(np.repeat(np.array(reps, np.int64), sizes)), pa.array(np.repeat(np.array(slacks, np.int32), sizes))]
            return pa.RecordBatch.from_arrays(columns, ["sig", "rep", "slack"])

        for b in batches:
            sigs, reps, slacks, held = [], [], [], 0
            for rep, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found, slack = signatures(shingles(text.as_py(), k), bands)
                for to, x in ((sigs, found), (reps, rep), (slacks, slack)):
                    to.append(x)
                held += len(found)
                if held > 200_000:
                    yield rows(sigs, reps, slacks)
                    sigs, reps, slacks, held = [], [], [], 0
            if sigs:
                yield rows(sigs, reps, slacks)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "sig long, rep long, slack int")


def possible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out; exact, as a sketch never overstates a difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            x, y, keep = batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), np.zeros(len(batch), bool)
            for at, left in by_size(x):
                for of, right in by_size([y[i] for i in at]):
                    words = min(left.shape[1], right.shape[1])
                    apart = np.bitwise_count(folded(left[of], words) ^ folded(right, words)).sum(1, dtype=np.int64)
                    keep[at[of]] = alike(n[at[of]], m[at[of]], apart, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    sided = pairs.join(reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa")), "a").join(
        reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb")), "b"
    )
    # Sizes are told before sketches are read.
    sided = sided.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return sided.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def forest(u: np.ndarray, v: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the edges (u, v) of a lightest spanning forest; equal weights go by ends."""
    ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    order = np.lexsort((v, u, weight))
    a, b = ends[: len(u)][order], ends[len(u) :][order]
    tree, left, taken, none = np.arange(len(ids)), np.arange(len(u)), np.zeros(len(u), bool), len(u)
    while True:
        left = left[tree[a[left]] != tree[b[left]]]
        if not len(left):
            return order[taken]
        lightest = np.full(len(ids), none)
        np.minimum.at(lightest, tree[a[left]], left)
        np.minimum.at(lightest, tree[b[left]], left)
        roots = np.flatnonzero(lightest < none)
        edge = lightest[roots]
        taken[edge] = True
        joins = np.arange(len(ids))
        joins[roots] = tree[a[edge]] + tree[b[edge]] - roots
        twice = roots[(joins[joins[roots]] == roots) & (roots < joins[roots])]  # two trees that took the same edge
        joins[twice] = twice
        while (joins[joins] != joins).any():
            joins = joins[joins]
        tree = joins[tree]


class Rows:
    """Bucket rows of one batch as arrays."""

    def __init__(self, lists: list[pa.ListArray]):
        rows = pa.concat_arrays([x.flatten() for x in lists])
        self.rep, self.label, self.n = (rows.field(c).to_numpy() for c in ("rep", "label", "n_shingles"))
        self.ahead = rows.field("ahead").to_numpy(zero_copy_only=False)
        self.sketches = rows.field("sketch").to_pylist()

    def edges(self, p: np.ndarray, q: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Columns label, label, rep, rep (the smaller first), distance of the pairs of rows (p, q)."""
        swap = self.rep[p] > self.rep[q]
        p, q = np.where(swap, q, p), np.where(swap, p, q)
        return np.stack([self.label[p], self.label[q], self.rep[p], self.rep[q], apart])

    def possible(self, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
        """Edges of those pairs of rows that sketches let pass."""
        out = [np.empty((5, 0), np.int64)]
        for at, left in by_size([self.sketches[i] for i in p]):
            for of, right in by_size([self.sketches[i] for i in q[at]]):
                words, x, y = min(left.shape[1], right.shape[1]), p[at[of]], q[at[of]]
                apart = np.bitwise_count(folded(left[of], words) ^ folded(right, words)).sum(1, dtype=np.int64)
                keep = alike(self.n[x], self.n[y], apart, percent)
                out.append(self.edges(x[keep], y[keep], apart[keep]))
        return np.concatenate(out, axis=1)

    def possible_between(self, one: np.ndarray, two: np.ndarray, percent: int, spanning: bool) -> np.ndarray:
        """As ``possible`` for all pairs of rows ``one`` and ``two`` with other labels; with ``spanning`` a forest of them."""
        held = [np.empty((5, 0), np.int64)]

        def reduced() -> np.ndarray:
            edges = np.concatenate(held, axis=1)
            return edges[:, forest(edges[0], edges[1], edges[4])] if spanning else np.unique(edges, axis=1)

        for at, left in by_size([self.sketches[i] for i in one]):
            for of, right in by_size([self.sketches[i] for i in two]):
                words = min(left.shape[1], right.shape[1])
                x, y, q = folded(left, words), folded(right, words), two[of]
                step = max(1, (1 << 20) // y.size)
                for k in range(0, len(x), step):
                    p = one[at[k : k + step]]
                    apart = np.bitwise_count(x[k : k + step, None] ^ y[None]).sum(2, dtype=np.int64)
                    i, j = np.nonzero(alike(self.n[p][:, None], self.n[q][None], apart, percent) & (self.label[p][:, None] != self.label[q][None]))
                    held.append(self.edges(p[i], q[j], apart[i, j]))
                    if sum(h.shape[1] for h in held) > HELD:
                        held = [reduced()]
        return reduced()


def possible_in_buckets(rows: DataFrame, reps: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """Pairs (a, b) of different labels, one of them ``ahead``, of one bucket that sizes and sketches don't rule out.

    ``rows``: sig, rep, label, n (rows of the bucket), ahead. With ``spanning`` a larger block gives a forest of its pairs only.
    """

    def pairs_of(batch: pa.RecordBatch) -> np.ndarray:
        one, two = batch.column("one"), batch.column("two")
        rows = Rows([two, one])
        ends, first = two.offsets.to_numpy() - two.offsets[0].as_py(), one.offsets.to_numpy() - one.offsets[0].as_py()
        first = first + ends[-1]
        small, found = [np.empty((2, 0), np.int64)], []
        for i in range(len(batch)):
            q = np.arange(ends[i], ends[i + 1])
            p = np.arange(first[i], first[i + 1]) if first[i] < first[i + 1] else q[rows.ahead[q]]
            if len(p) * len(q) <= 1024:
                n, m = rows.n[p][:, None], rows.n[q][None]
                x, y = np.nonzero((rows.label[p][:, None] != rows.label[q][None]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
                small.append(np.stack([p[x], q[y]]))
            else:
                found.append(rows.possible_between(p, q, percent, spanning)[2:4])
        return np.concatenate([rows.possible(*np.concatenate(small, axis=1), percent)[2:4], *found], axis=1).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, c].copy()) for c in (0, 1)], ["a", "b"])

        # A pair often shares many signatures: each task reports it once, as long as it holds at most HELD pairs.
        held = np.empty((0, 2), np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                held = np.unique(np.concatenate([held, pairs_of(batch.slice(at, 1024))]), axis=0)
                if len(held) > HELD:
                    yield out(held)
                    held = held[:0]
        yield out(held)

    sketches = reps.select(F.col("doc_id").alias("rep"), "n_shingles", "sketch")
    # Blocks are bounded by rows and, as a sketch grows with its set, by bytes.
    long = materialize(sketches.where(F.octet_length("sketch") > WIDE).select("rep", F.octet_length("sketch").alias("bytes")), "wide")
    wide = materialize(rows.join(checked_broadcast(long), "rep").groupBy("sig").agg(F.sum("bytes").alias("bytes")), "wide-buckets")
    rows = rows.join(checked_broadcast(wide), "sig", "left")
    blocks = (F.ceil(F.col("n") / BLOCK) + F.floor(F.coalesce("bytes", F.lit(0)) / BLOCK_BYTES)).cast("int")
    dealt = rows.join(sketches, "rep").select(
        "sig", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"), F.struct("rep", "label", "n_shingles", "sketch", "ahead").alias("row")
    )
    lists = materialize(dealt.groupBy("sig", "blocks", "block").agg(F.collect_list("row").alias("two")), "blocks")
    ahead, single = F.filter("two", lambda r: r["ahead"]), F.col("blocks") == 1
    # In larger buckets each block meets every block, keyed by the bucket and the block.
    met = lists.where(~single).select("sig", "blocks", ahead.alias("one")).where(F.size("one") > 0)
    met = met.select("sig", "one", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    split = met.join(lists.where(~single).select("sig", "block", "two"), ["sig", "block"]).select("one", "two")
    # Where a bucket is one block, ``one`` is empty and stands for the rows ahead of ``two``.
    return lists.where(single).select(F.slice("two", 1, 0).alias("one"), "two").unionByName(split).mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts have the asked similarity, materialized."""
    pairs = materialize(pairs, "possible")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t.as_py(), k).tobytes() for t in b.column(1)], pa.binary())], ["doc_id", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                r, s = (np.frombuffer(v.as_buffer(), U) for v in (x, y))
                both = len(np.intersect1d(r, s, assume_unique=True))
                if 100 * both >= percent * (len(r) + len(s) - both):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ends")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(checked_broadcast(ids), "doc_id")
    ends = materialize(texts.mapInArrow(sets, "doc_id long, s binary").dropDuplicates(["doc_id"]), "shingles")
    sided = pairs.join(ends.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a").join(ends.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b")
    return materialize(sided.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes of the links a-b, the smallest node that each reaches)."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = ends[: len(a)], ends[len(a) :], np.arange(len(ids))
    while True:
        u, v = label[x], label[y]
        apart = u != v
        if not apart.any():
            return ids, ids[label]
        x, y, u, v = x[apart], y[apart], u[apart], v[apart]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while (label[label] != label).any():
            label = label[label]


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the ends of ``links`` (a, b): the smallest node that links reach.

    Parts of at most about ``PART_LINKS`` links are brought to stars first, each by itself; few links
    are one part, and then that is all. What several parts leave is joined by rounds that take
    the smallest label of the neighbours and then the label's own label, so
    chains shrink by halves. Rounds end when no label changes.
    """
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()]) for b in batches]
        a, b = np.concatenate([np.empty((2, 0), np.int64), *rows], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in roots(a, b)], ["a", "b"])

    parts = max(1, -(-links.count() // PART_LINKS))
    links = materialize(links.select("a", "b").coalesce(parts).mapInArrow(stars, "a long, b long"), "stars")
    if parts == 1:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    both = materialize(links.union(links.select("b", "a")).where("a != b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        far = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        step = step.join(far, step["label"] == far["via"]).select("node", "old", F.least("label", "far").alias("label"))
        step = materialize(step, "labels")
        labels = step.select("node", "label")
        if step.where("label < old").isEmpty():
            return labels


def members_of(sigs: DataFrame) -> DataFrame:
    """(sig, rep) of the buckets of two or more, without the rows of long lists that their set can do without."""
    bucket = Window.partitionBy("sig")
    listed = sigs.select("sig", "rep", "slack", F.count("*").over(bucket).alias("n")).where("n > 1")
    listed = materialize(listed.select("sig", "rep", "slack", (F.col("n") > LONG).alias("long")), "listed")
    needing = listed.where("long").groupBy("rep").agg(F.count("*").alias("lists"), F.max("slack").alias("slack")).where("lists > slack").select("rep")
    return materialize(listed.where("not long").select("sig", "rep").unionByName(listed.where("long").join(needing, "rep", "left_semi").select("sig", "rep")), "members")


def groups_of(reps: DataFrame, docs: DataFrame, k: int, percent: int, steps: int) -> DataFrame:
    """(node, label) of the set representatives that have a link, from the signatures of their texts (``docs``)."""
    members = members_of(signature_rows(docs, k, percent, steps))
    pivots = members.groupBy("sig").agg(F.min("rep").alias("pivot"))
    pairs = members.join(pivots, "sig").where("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = verified(possible(pairs, reps, percent), docs, k, percent)
    labels = components(links)
    # A pivot has met its whole bucket: no link of it is missing there, so it leaves.
    open_ = unsettled(members.join(pivots, "sig").where("rep != pivot"), labels)

    def joined(rows: DataFrame, spanning: bool) -> None:
        nonlocal links, labels
        found = verified(possible_in_buckets(rows, reps, percent, spanning), docs, k, percent)
        if not found.isEmpty():
            links = materialize(links.union(found), "links")
            labels = components(links)

    ahead = F.col("label") != F.col("main")
    while True:
        size = open_.agg(F.count("*"), F.sum(F.when(ahead, F.col("n")))).first()
        if not size[0]:
            return labels
        # Rows are taken outside the largest part: once none is left there, the bucket is one group.
        last, turn = (size[1] or 0) <= max(1_000_000, PAIRS_PER_MEMBER * size[0]), open_.where(ahead).select("sig", "rep")
        turn = materialize(turn if last else smallest(turn, PIVOTS), "turn")
        for spanning in (True, False):
            rows = open_ if spanning else unsettled(open_, labels)
            flagged = rows.join(turn.withColumn("ahead", F.lit(True)), ["sig", "rep"], "left").withColumn("ahead", F.coalesce("ahead", F.lit(False)))
            joined(flagged, spanning)
        if last:
            return labels
        open_ = unsettled(open_.join(turn, ["sig", "rep"], "left_anti"), labels)


def unsettled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, rep, label, n, main) of the buckets of ``rows`` (sig, rep) that aren't one group: their rows and largest label."""
    rows = rows.select("sig", "rep").join(labels, F.col("rep") == labels["node"], "left").select("sig", "rep", F.coalesce("label", "rep").alias("label"))
    parts = rows.groupBy("sig", "label").agg(F.count("*").alias("n"))
    whole = parts.groupBy("sig").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main")).where("parts > 1")
    return materialize(rows.join(whole.select("sig", "n", F.col("main.label").alias("main")), "sig"), "open")


def smallest(rows: DataFrame, n: int) -> DataFrame:
    """(sig, rep): the ``n`` smallest representatives of each bucket; ranks are cut before the shuffle."""
    order = Window.partitionBy("sig").orderBy("rep")
    return rows.select("sig", "rep", F.row_number().over(order).alias("rank")).where(F.col("rank") <= n).select("sig", "rep")


def similarity_groups(docs: DataFrame, k: int = 5, percent: int = 80, steps: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``; links need ``percent`` similarity.

    A null or empty text has no shingles and is linked with nothing: component_id is its doc_id.
    The smallest doc_id of a group names it. Other texts under one doc_id are documents of their
    own. A null doc_id gets the group of the equal sets that have one, else null. Whole texts are
    read, however long; other columns are ignored; an empty table gives an empty result.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(grouped(docs, k, percent, steps), "groups")


def grouped(docs: DataFrame, k: int, percent: int, steps: int) -> DataFrame:
    sets = materialize(shingle_sets(docs, k), "sets")
    if ids_repeat(sets):
        numbered, nodes = one_id_a_text(docs)
        found = grouped(numbered, k, percent, steps)
        for node, name in (("doc_id", "id"), ("component_id", "component")):
            found = found.join(nodes.select(F.col("node").alias(node), F.col("doc_id").alias(name)), node, "left")
        return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
    full = sets.where("n_shingles > 0")
    classes = materialize(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    copies = materialize(full.join(classes, "digest").where("doc_id != rep").select("doc_id").distinct(), "copies")
    reps = drop_ids(full.where("doc_id is not null"), copies, "copies").dropDuplicates(["doc_id"])
    texts = drop_ids(docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null"), copies, "copies")
    labels = groups_of(materialize(reps, "reps"), texts, k, percent, steps)
    named = classes.join(labels, classes["rep"] == labels["node"], "left").select("digest", F.coalesce("label", "rep").alias("component_id"))
    found = full.select("doc_id", "n_shingles", "digest").join(named, "digest").select("doc_id", "n_shingles", "component_id")
    return found.unionByName(sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def ids_repeat(sets: DataFrame) -> bool:
    """Whether a doc_id has more than one set."""
    return not sets.where("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("not a <=> b").isEmpty()


def one_id_a_text(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a node for doc_id, one for each text of an id, and (doc_id, _sha, node); nodes rise with doc_id, null stays null."""
    keyed = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("_sha", text_hash())
    nodes = keyed.where("doc_id is not null").select("doc_id", "_sha").distinct().orderBy("doc_id", "_sha")
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    numbered = keyed.join(nodes, ["doc_id", "_sha"], "left").withColumn("doc_id", F.col("node"))
    return materialize(numbered.select(docs.columns), "numbered"), nodes


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, the smallest doc_id, of each group of near copies; null ids are kept."""
    texts = docs.where("doc_id is not null").select("doc_id", text_hash().alias("t")).groupBy("doc_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    if texts.where("a != b").isEmpty():
        found = similarity_groups(docs, k, percent)
        return drop_ids(docs, found.where("doc_id != component_id").select("doc_id"), "near")
    numbered, nodes = one_id_a_text(docs)
    back = keep_one(numbered, k, percent).withColumnRenamed("doc_id", "node").join(nodes.drop("_sha"), "node", "left")
    return back.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)).select(docs.columns)
