"""Periodic runs of words by string synchronising sets.

A run of period q is sought at the dyadic scale tau <= q < 2 * tau. There a position is chosen when
the smallest hash of the tau-word fragments that begin in the tau + 1 places from it on belongs to
its first or last place; whether it is chosen depends on the 2 * tau words behind it alone, so equal
contexts are chosen alike. Fragments inside highly periodic regions (period <= tau / 4) take no part,
else all places of such a region would be chosen. A run of at least 4 * q words is no such region
at its scale, so one of its first tau places is chosen, the same place one period later has the same
context, and no place between has: the next chosen place with an equal context proposes the period.
The region is then compared word by word and extended as far as it goes. Periods below the
smallest scale are detected separately; the highly periodic regions that a scale leaves out are
those found at smaller scales. Contexts are compared by 64-bit fingerprints: a collision could hide
a run (chance below n * n / 2**64), never make one.

Fragments, minima and contexts are computed for many texts at once; a text takes part in the scales
of at most a quarter of its words, so the work is n log n and memory is in proportion to the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that are worked on together (a longer text is taken alone); scale of the first synchronising set.
BLOCK_WORDS, FIRST_SCALE = 200_000, 4
#: A reported run has at least this many words and repetitions of its period.
LEAST_WORDS, REPEATS = 6, 4
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

Region = tuple[int, int, int]


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(h: np.ndarray, by: int) -> np.ndarray:
    """Fingerprints of fragments twice as long; the last ``by`` places reach over the end and mean nothing."""
    with np.errstate(over="ignore"):
        return mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([h[by:], h[:by]]))


def window_min(x: np.ndarray, size: int) -> np.ndarray:
    """Smallest of ``x[i : i + size]`` for every i, whatever the size: prefix and suffix minima of blocks."""
    padded = np.full(-(-(len(x) + size) // size) * size, NEVER)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x)], ahead[size - 1 : size - 1 + len(x)])


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two arrays of one size, read in growing pieces."""
    at, step = 0, 64
    while at < len(a):
        differ = a[at : at + step] != b[at : at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return len(a)


def small_periods(words: np.ndarray, room: np.ndarray) -> list[Region]:
    """Regions of a period below ``FIRST_SCALE``, by comparing each word with the one a period later."""
    found = []
    for q in range(1, FIRST_SCALE):
        same = np.zeros(len(words) + 1, bool)
        same[: -q - 1] = (words[:-q] == words[q:]) & (room[:-q] > q)
        edges = np.flatnonzero(np.diff(same, prepend=False))
        starts, stops = edges[::2], edges[1::2]
        enough = stops - starts >= (REPEATS - 1) * q
        for start, stop in zip(starts[enough].tolist(), stops[enough].tolist(), strict=True):
            if not any(q % p == 0 and (words[start : start + q - p] == words[start + p : start + q]).all() for p in range(1, q)):
                found.append((start, stop - start + q, q))
    return found


def regions(words: np.ndarray, sizes: np.ndarray) -> list[Region]:
    """(start, length, period) of all maximal regions of at least ``REPEATS`` smallest periods in texts of ``sizes`` words that lie one behind the other."""
    if not len(words):
        return []
    ends = np.repeat(np.cumsum(sizes), sizes)
    size = np.repeat(sizes, sizes)
    room, place = ends - np.arange(len(words)), np.arange(len(words))
    found = small_periods(words, room)
    at, tau = place, 1
    h = mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while tau < FIRST_SCALE:
        h, tau = joined(h, tau), tau * 2
    while 4 * tau <= int(sizes.max()):
        # The texts that are long enough for this scale; each keeps its places together.
        long = size[at] >= REPEATS * tau
        at, h = at[long], h[long]
        left = room[at]
        order = mixed(h + np.uint64(tau))
        order[left < tau] = NEVER
        for start, length, q in found:
            if 4 * q <= tau <= length and size[start] >= REPEATS * tau:
                first = int(np.searchsorted(at, start))
                order[first : first + length - tau + 1] = NEVER
        least = window_min(order, tau + 1)
        last = np.concatenate([order[tau:], np.full(min(tau, len(order)), NEVER)])
        context = joined(h, tau)
        chosen = np.flatnonzero((least < NEVER) & ((order == least) | (last == least)) & (left >= 2 * tau))
        by_context = np.argsort(context[chosen], kind="stable")
        c, s = context[chosen][by_context], at[chosen][by_context]
        d = s[1:] - s[:-1]
        pair = (c[1:] == c[:-1]) & (d >= tau) & (d < 2 * tau) & (room[s[:-1]] >= d + 2 * tau)
        proposed = sorted(zip(s[:-1][pair].tolist(), d[pair].tolist(), strict=True))
        covered: dict[int, int] = {}  # period -> end of the last region with it
        for start, q in proposed:
            if start + q < covered.get(q, 0):
                continue
            begin, end = int(ends[start] - size[start]), int(ends[start])
            back = agreeing(words[begin:start][::-1], words[begin + q : start + q][::-1])
            ahead = agreeing(words[start : end - q], words[start + q : end])
            if ahead >= 2 * tau:
                covered[q] = start + ahead + q
                if back + ahead + q >= REPEATS * q:
                    found.append((start - back, back + ahead + q, q))
        h, tau = context, tau * 2
    return found


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a tail made periodic in every tenth document, as a hash of the id says (a null id counts as the empty text)."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def report(words: list[bytes], runs: list[Region]) -> tuple:
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of one text."""
    runs = sorted((r for r in runs if r[1] >= LEAST_WORDS), key=lambda r: (r[0], r[2]))
    listed = sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    if not runs:
        return 0, None, None, None, None, listed, sha256(b" ".join(words)).hexdigest()
    change = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        change[s + q] += 1
        change[s + n] -= 1
    kept = (np.cumsum(change[:-1]) == 0).tolist()
    s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    collapsed = sha256(b" ".join(w for w, k in zip(words, kept, strict=True) if k)).hexdigest()
    return len(runs), s, n, q, 1000 * n // q, listed, collapsed


FIELDS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def find_runs(docs: DataFrame, plant: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the run with most repetitions (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    A run is a stretch of words with smallest period q and at least ``LEAST_WORDS`` and ``REPEATS`` * q words
    that no neighbour extends; words of a run behind its first period are left out of the collapsed
    text. Of equal exponents the first start counts, then the smaller period. With ``plant`` the words
    of every tenth text are first made periodic by a rule on its doc_id.

    Null and empty texts, and those of white space only, have no words and no runs; rows that repeat are
    reported each; a null doc_id stays null; texts are read whole at any length (a task holds one at a
    time); an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        held: list[tuple[int | None, list[bytes], np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            sizes = np.array([len(x) for _, _, x in held], np.int64)
            ends = np.cumsum(sizes)
            of: dict[int, list[Region]] = {}
            for start, length, q in regions(np.concatenate([x for _, _, x in held]), sizes):
                k = int(np.searchsorted(ends, start, "right"))
                of.setdefault(k, []).append((start - int(ends[k] - sizes[k]), length, q))
            out = [(doc_id, *report(words, of.get(k, []))) for k, (doc_id, words, _) in enumerate(held)]
            held.clear()
            columns = list(zip(*out, strict=True))
            types = [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", *FIELDS])

        total = 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                # bytes.split() cuts at the six ASCII white-space characters, no others.
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                words = planted(words, doc_id) if plant else words
                if held and total + len(words) > block_words:
                    yield rows()
                    total = 0
                if not held:
                    numbers.clear()
                number = numbers.setdefault
                held.append((doc_id, words, np.array([number(w, len(numbers)) for w in words], np.int64)))
                total += len(words)
        if held:
            yield rows()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
