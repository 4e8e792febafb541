"""Subword lattice language model: a word's probability sums over all its segmentations.

The pieces are those of an existing subword vocabulary; their scores start from its order and are
re-estimated on the training documents by expectation-maximisation: the expected uses of each
piece over all segmentations of every distinct training word. A word is a path of pieces that
begins with the word mark; a word seen in training has one arc more, from end to end, weighted by
its count. What the lattice keeps for its pieces is the share of words seen once (Good-Turing). A
text is its words and one end; its probability is the product, and over all texts it sums to one.
The recursion that scores runs in log space, on words of one length at a time; the one that counts in plain numbers where they hold it.

Within a text the lattice of the next word gains arcs for the words before it: one weighted by how
often the word came so far, one by how often it followed the same word. Both are Dirichlet priors
around the arcs above, so the sum stays one; a text's probability is the mean over the pairs of strengths in ``PRIORS``.

Words are counted by Spark over all documents. To score, each block of documents gets the counts
and probabilities of just its own distinct words by a join, so no table of all words is ever held
in one place and the only text that moves is each document, once.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, scratch, whole_text
from .jaccard_join import mix
from .tokens import vocabulary_path

PIECES, WORD_MARK, BLOCK_CHARS = "piece_bpe_32k.model", "▁", 16_000_000
FLOOR = 0.01
#: Times the mean length from which on a text is dealt with others of its length.
LONG = 16
#: Strengths (in words) of the corpus against the text so far, and of both against what followed the same word.
PRIORS = ((100, 1000, 10_000, 100_000), (5, 2000))
#: Least log-probability that sums with counts as a plain number.
SMALL = -600.0
#: Least probability of a word that sums of products give exactly enough.
LEAST = 1e-250
U = np.uint64


def words_of(text: str | None) -> list[bytes]:
    """ASCII lower case; words are runs without ASCII white space."""
    return (text or "").encode("utf-8", "replace").lower().split()


class Lattice:
    """All segmentations of many words at once into the pieces of a vocabulary file."""

    def __init__(self, vocabulary: str = PIECES):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary))
        self.size = model.vocab_size()
        self.bytes_ = np.zeros(256, np.int64)
        normal, rank = [], np.full(self.size, np.inf)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_[int(piece[3:5], 16)] = i
                rank[i] = self.size
            elif not (model.is_control(i) or model.is_unknown(i)):
                normal.append((piece, i))
                rank[i] = -model.get_score(i)
        self.usable = np.isfinite(rank)
        with np.errstate(divide="ignore"):
            self.start = np.log(1 / (rank + 10)) - np.log((1 / (rank + 10)).sum())
        self.opening = np.array([model.id_to_piece(i).startswith(WORD_MARK) for i in range(self.size)])
        self.longest = max(len(p) for p, _ in normal)
        # Open addressing: hash of the piece -> id.
        keys = np.array([self.hashed(p) for p, _ in normal], U)
        self.mask = U((1 << 20) - 1)  # sparse, so that two or three looks suffice
        self.keys, self.ids, self.probes = np.zeros(1 << 20, U), np.full(1 << 20, -1, np.int32), 1
        for key, (_, i) in zip(keys.tolist(), normal, strict=True):
            at, probes = key & int(self.mask), 1
            while self.ids[at] >= 0:
                at, probes = (at + 1) & int(self.mask), probes + 1
            self.keys[at], self.ids[at], self.probes = key, i, max(self.probes, probes)

    @staticmethod
    def hashed(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * 0x100000001B3 + ord(c) + 1) & (1 << 64) - 1
        return int(mix(np.array([h], U))[0])

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece id of each hash, -1 without one; only places taken by another piece are looked at again."""
        key = mix(h)
        at = key & self.mask
        ids = self.ids[at]
        out = np.where(self.keys[at] == key, ids, -1).ravel()
        left = np.flatnonzero((ids.ravel() >= 0) & (out < 0))
        key, at = key.ravel()[left], at.ravel()[left]
        for _ in range(self.probes - 1):
            at = (at + U(1)) & self.mask
            ids = self.ids[at]
            hit = (self.keys[at] == key) & (ids >= 0)
            out[left[hit]] = ids[hit]
            again = ~hit & (ids >= 0)
            left, key, at = left[again], key[again], at[again]
        return out.reshape(h.shape)

    def arcs(self, points: np.ndarray) -> list[np.ndarray]:
        """For words of one length (rows of code points): piece ids by arc length, -1 where there is none."""
        n, length = points.shape
        h, out = np.zeros((n, length), U), []
        for size in range(1, min(self.longest, length) + 1):
            with np.errstate(over="ignore"):
                h = h[:, : length - size + 1] * U(0x100000001B3) + (points[:, size - 1 :] + U(1))
            out.append(self.find(h))
        return out

    def spelled(self, points: np.ndarray, arcs: list[np.ndarray], logp: np.ndarray) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Log-probability of each character that has no piece of its own, by its UTF-8 bytes."""
        extra, parts = np.full(points.shape, -np.inf), {}
        missing = arcs[0] < 0
        if missing.any():
            for c in np.unique(points[missing]).tolist():
                parts[c] = self.bytes_[list(chr(c).encode("utf-8", "replace"))].tolist()
                extra[missing & (points == U(c))] = logp[parts[c]].sum()
        return extra, parts

    def forward(self, arcs: list[np.ndarray], extra: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """alpha[:, e]: log-probability of all segmentations of the first e characters."""
        n, length = extra.shape
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        for e in range(1, length + 1):
            paths = [alpha[e - s] + logp[arcs[s - 1][:, e - s]] for s in range(1, min(e, len(arcs)) + 1)]
            alpha[e] = log_sum([*paths, alpha[e - 1] + extra[:, e - 1]])
        return alpha

    def backward(self, arcs: list[np.ndarray], extra: np.ndarray, logp: np.ndarray) -> np.ndarray:
        n, length = extra.shape
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0
        for b in range(length - 1, -1, -1):
            paths = [beta[b + s] + logp[arcs[s - 1][:, b]] for s in range(1, min(length - b, len(arcs)) + 1)]
            beta[b] = log_sum([*paths, beta[b + 1] + extra[:, b]])
        return beta

    def by_length(self, words: list[str], rows: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions in ``words``, their code points with the word mark) for words of one length."""
        groups = defaultdict(list)
        for i, w in enumerate(words):
            groups[len(w)].append(i)
        for length, at in groups.items():
            step = max(1, rows * 16 // (length + 1))
            for k in range(0, len(at), step):
                part = at[k : k + step]
                text = "".join(WORD_MARK + words[i] for i in part)
                yield np.array(part), np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(part), length + 1).astype(U)

    def log_probability(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        out, logp = np.empty(len(words)), np.append(logp, -np.inf)
        for at, points in self.by_length(words):
            arcs = self.arcs(points)
            out[at] = self.forward(arcs, self.spelled(points, arcs, logp)[0], logp)[-1]
        return out

    def per_word(self, logp: np.ndarray) -> float:
        """Log of what turns a path into a share of all words: it opens with a marked piece, then no unmarked one follows."""
        return -float(np.log(np.exp(logp[self.opening]).sum())) + float(np.log1p(-np.exp(logp[~self.opening]).sum()))

    def expected(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in all segmentations of ``words``.

        Sums of products of plain probabilities; words that are too improbable for a number go by logarithms.
        """
        out, logp = np.zeros(self.size + 1), np.append(logp, -np.inf)
        p = np.exp(logp)
        for at, points in self.by_length(words):
            arcs = self.arcs(points)
            extra, parts = self.spelled(points, arcs, logp)
            own, (n, length) = np.exp(extra), points.shape
            steps = [p[ids] for ids in arcs]
            steps[0] = steps[0] + own  # a character has a piece of its own or is spelled
            alpha, beta = np.zeros((length + 1, n)), np.zeros((length + 1, n))
            alpha[0] = beta[length] = 1
            for e in range(1, length + 1):
                for s in range(1, min(e, len(steps)) + 1):
                    alpha[e] += alpha[e - s] * steps[s - 1][:, e - s]
            sure = alpha[-1] > LEAST
            if not sure.all():
                out += self.expected_by_logarithms(points[~sure], logp)
                if not sure.any():
                    continue
            for b in range(length - 1, -1, -1):
                for s in range(1, min(length - b, len(steps)) + 1):
                    beta[b] += beta[b + s] * steps[s - 1][:, b]
            weight = np.where(sure, 1 / np.where(sure, alpha[-1], 1), 0)
            for s, ids in enumerate(arcs, 1):
                use = alpha[: length - s + 1] * p[ids].T * beta[s:] * weight
                out += np.bincount((ids % (self.size + 1)).ravel(), use.T.ravel(), self.size + 1)
            for c, ids in parts.items():
                use = (alpha[:-1].T * own * beta[1:].T * weight[:, None])[(points == U(c)) & (own > 0)].sum()
                for i in ids:
                    out[i] += use
        return out[:-1]

    def expected_by_logarithms(self, points: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """As ``expected`` for words of one length, with a last entry for no piece."""
        out, arcs = np.zeros(self.size + 1), self.arcs(points)
        extra, parts = self.spelled(points, arcs, logp)
        alpha, beta = self.forward(arcs, extra, logp), self.backward(arcs, extra, logp)
        weight = -alpha[-1]
        length = points.shape[1]
        for s, ids in enumerate(arcs, 1):
            for b in range(length - s + 1):
                use = np.exp(alpha[b] + logp[ids[:, b]] + beta[b + s] + weight)
                out += np.bincount(ids[:, b] % (self.size + 1), use, self.size + 1)
        for c, ids in parts.items():
            use = np.exp(alpha[:-1].T + extra + beta[1:].T + weight[:, None])[(points == U(c)) & np.isfinite(extra)].sum()
            for i in ids:
                out[i] += use
        return out


def log_sum(paths: list[np.ndarray]) -> np.ndarray:
    all_ = np.stack(paths)
    top = all_.max(0)
    top[~np.isfinite(top)] = 0
    with np.errstate(divide="ignore"):
        return np.log(np.exp(all_ - top).sum(0)) + top


def earlier(x: np.ndarray) -> np.ndarray:
    """For each item, how many equal ones come before it."""
    order = np.argsort(x, kind="stable")
    starts = np.flatnonzero(np.diff(x[order], prepend=x[order[:1]] - 1))
    out = np.empty(len(x), np.int64)
    out[order] = np.arange(len(x)) - np.repeat(starts, np.diff(starts, append=len(x)))
    return out


def in_context(at: np.ndarray, lp: np.ndarray, priors: tuple[tuple[float, ...], tuple[float, ...]] = PRIORS) -> float:
    """Natural log-probability of the words ``at``, whose lattice alone gives ``lp``, each after those before it."""
    if not len(at):
        return 0.0
    before = np.concatenate([[-1], at[:-1]])
    word, pair = earlier(at).astype(float), earlier((before + 1) * (at.max() + 2) + at).astype(float)
    so_far, followed, totals = np.arange(len(at)), earlier(before), []
    # Sums of counts and priors need no logarithms. What is too small for a number is put apart; it only matters where no count is.
    own, small = np.exp(np.maximum(lp, SMALL)), (lp < SMALL) & (word == 0)
    apart = (lp[small] - SMALL).sum()
    for mu in priors[0]:
        one = (word + mu * own) / (so_far + mu)
        totals += [apart + np.log((pair + nu * one) / (followed + nu)).sum() for nu in priors[1]]
    return float(np.logaddexp.reduce(totals) - np.log(len(totals)))


def with_blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """(doc_id, text, learn, block): blocks are runs of rows of a file, about ``block_chars`` long.

    A run has as many rows as would be ``block_chars`` at the mean length. Texts of over ``LONG`` times the mean go to blocks
    of texts of their own length, whose runs have accordingly fewer rows, so no block holds more than ``LONG`` * ``block_chars``
    and a longer text is alone.
    """
    try:
        stored = docs.select("doc_id", whole_text().alias("text"), "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:  # not read from files: write it
        stored = materialize(docs.select("doc_id", "text"), "docs").select("doc_id", whole_text().alias("text"), "_metadata.file_path", "_metadata.row_index")
    mean = stored.agg(F.avg(F.octet_length("text"))).first()[0] or 1
    rows, times = max(1, int(block_chars / max(mean, 1))), F.octet_length("text") / max(mean, 1)
    size = F.when(times > LONG, F.ceil(F.log2(times))).otherwise(0)
    run = F.floor(F.col("row_index") / F.greatest(F.lit(1), F.floor(rows / F.pow(F.lit(2), size))))
    return stored.select("doc_id", "text", (fold(F.col("doc_id"), 7) != 2).alias("learn"), F.xxhash64("file_path", size, run).alias("block"))


def block_words(blocked: DataFrame) -> DataFrame:
    """(block, word, c): distinct words of each block and task, with their count in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, tuple[Counter, set]] = {}
            for text, learn, block in zip(*(batch.column(c).to_pylist() for c in ("text", "learn", "block")), strict=True):
                counts, others = seen.setdefault(block, (Counter(), set()))
                (counts if learn else others).update(words_of(text))
            for block, (counts, others) in seen.items():
                words = [*counts, *(others := others.difference(counts))]
                c = np.concatenate([np.fromiter(counts.values(), np.int64, len(counts)), np.zeros(len(others), np.int64)])
                for at in range(0, len(words), 100_000):
                    part = pa.array(words[at : at + 100_000], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), part, pa.array(c[at : at + 100_000])], ["block", "word", "c"])

    return blocked.select("text", "learn", "block").mapInArrow(run, "block long, word binary, c long")


def decoded(words: pa.Array) -> list[str]:
    return [w.decode("utf-8", "replace") for w in words.to_pylist()]


def trained_pieces(words: DataFrame, rounds: int, vocabulary: str) -> np.ndarray:
    """Log-probabilities of the pieces after ``rounds`` of expectation-maximisation over all training words."""
    lattice = Lattice(vocabulary)
    logp = lattice.start
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], logp: np.ndarray = logp) -> Iterator[pa.RecordBatch]:
            mine, total = Lattice(vocabulary), None
            for b in batches:
                found = mine.expected(decoded(b.column(0)), logp)
                total = found if total is None else total + found
            if total is not None:
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

        uses = words.where("c > 0").select("word").mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        got = uses.toPandas()  # at most one row per piece of the vocabulary
        counts = np.zeros(lattice.size)
        counts[got["piece"].to_numpy(np.int64)] = got["uses"].to_numpy()
        counts = np.where(lattice.usable, counts + FLOOR, 0)
        with np.errstate(divide="ignore"):
            logp = np.log(counts / counts.sum())
    return logp


def score_documents(docs: DataFrame, rounds: int = 2, vocabulary: str = PIECES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Rows whose crc32(doc_id) mod 7 is not 2 are learned from. A null or empty text is the end
    token alone. Rows that repeat a doc_id are scored each; a null doc_id counts as the empty
    text in the split. With no training row every count is 0 and the pieces keep their start. Texts
    of any length are read whole; an empty table gives an empty result; other columns are ignored.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(scored(docs, rounds, vocabulary, block_chars), "scores")


def scored(docs: DataFrame, rounds: int, vocabulary: str, block_chars: int) -> DataFrame:
    blocked = with_blocks(docs, block_chars)
    local = materialize(block_words(blocked).groupBy("block", "word").agg(F.sum("c").alias("c")), "blockwords")
    words = materialize(local.groupBy("word").agg(F.sum("c").alias("c")), "words")
    n_words, v, once = words.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1)).first()
    n_docs = blocked.where("learn").count()
    n_words, v = n_words or 0, v + (n_docs > 0)
    n = n_words + n_docs
    logp = trained_pieces(words, rounds, vocabulary)
    end = n_docs / n if n_words and n_docs else 0.5
    seen = min(1 - once / n_words, 1 - 1 / (n_words + 1)) if n_words else 0.0
    per_word = Lattice(vocabulary).per_word(logp)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary)
        for b in batches:
            pieces = lattice.log_probability(decoded(b.column(0)), logp) + per_word
            with np.errstate(divide="ignore"):
                own = np.log(b.column(1).to_numpy() * (seen / max(n_words, 1)))
                lp = np.logaddexp(own, pieces + np.log(1 - seen))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lp)], ["word", "c", "lp"])

    rated = words.select("word", "c").mapInArrow(rate, "word binary, c long, lp double")
    known = local.select("block", "word").join(rated, "word")
    size, go_on, end_lp = float(n + v + 1), float(np.log1p(-end)), float(np.log(end))

    def score(key: tuple, texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        index = {w: i for i, w in enumerate(dictionary.column("word").to_pylist())}
        c, lp = (dictionary.column(k).to_numpy() for k in ("c", "lp"))
        base = np.log10((c + 1) / size)
        rows = []
        for text in texts.column("text").to_pylist():
            words = words_of(text)
            at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            rows.append((len(at) + 1, int((c[at] > 0).sum()) + (n_docs > 0), float(base[at].sum() + np.log10((n_docs + 1) / size)), (in_context(at, lp[at]) + len(at) * go_on + end_lp) / np.log(10), len((text or "").encode("utf-8", "replace"))))
        n_tokens, n_known, base_score, total, bytes_ = (np.array(x) for x in zip(*rows, strict=True))
        return pa.table(
            {
                "doc_id": texts.column("doc_id"), "held_out": pa.array([not x for x in texts.column("learn").to_pylist()]), "n_tokens": n_tokens.astype(np.int64),
                "n_known": n_known.astype(np.int64), "train_tokens": np.full(len(rows), n, np.int64), "base_score": base_score, "score": total,
                "bits_per_byte": -total / np.log10(2) / np.maximum(bytes_, 1),
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    texts = blocked.select(F.col("doc_id").cast("long"), "text", "learn", "block")
    # A block whose texts are all empty has no words and still its documents.
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)
