"""Toxicity by a counterfactual-regularised linear classifier.

A text is the set of its words and word beginnings (4 to 6 letters), hashed. A logistic
regression is fitted by follow-the-regularised-leader with elastic net on at most ``per_label``
labelled training documents of each label (in expectation: a hash of the id draws them). Wherever
a training text names a group, the names are swapped for those of other groups and the squared
change of the score is penalised, so the mere mention of a group can't carry weight. Sampling by
label is undone in the intercept. Every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_ids, fold
from .linear import Ftrl

BITS, PER_LABEL, EPOCHS, SWAPS, PENALTY, THRESHOLD = 20, 4000, 4, 2, 1.0, 0.3
WORDS = re.compile(r"[^\W\d_]+")

# Group names that may stand for each other, by family.
IDENTITY = (
    "muslim christian jewish hindu buddhist atheist catholic sikh",
    "muslims christians jews hindus buddhists atheists catholics sikhs",
    "gay straight lesbian bisexual transgender queer",
    "black white asian latino african european arab indian",
    "women men girls boys",
    "woman man girl boy",
    "immigrant refugee foreigner migrant",
    "immigrants refugees foreigners migrants",
    "disabled blind deaf autistic",
    "frauen männer mädchen jungen",
    "juden christen muslime atheisten",
    "femmes hommes filles garçons",
    "juifs chrétiens musulmans athées",
    "mujeres hombres niñas niños",
    "judíos cristianos musulmanes ateos",
)
FAMILY = {name: family.split() for family in IDENTITY for name in family.split()}


def words(text: str | None) -> set[str]:
    return set(WORDS.findall((text or "").lower()))


def word_features(word: str, bits: int) -> set[int]:
    """The word itself and its beginnings, hashed apart."""
    from xxhash import xxh3_64_intdigest

    keys = ["=" + word, *(f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
    return {xxh3_64_intdigest(k.encode()) >> 64 - bits for k in keys}


def active_features(word: str, weights: dict[int, float], bits: int) -> tuple[int, ...]:
    """Those of ``word_features`` with a weight; most words have none, and these share one empty tuple."""
    return tuple(x for x in word_features(word, bits) if x in weights)


def features(found: set[str], bits: int) -> np.ndarray:
    return np.array(sorted(set().union(*(word_features(w, bits) for w in found))) if found else [], np.int64)


def swapped(found: set[str], turn: int) -> set[str] | None:
    """``found`` with every group name replaced by the one ``turn`` further in its family; None without any."""
    named = found & FAMILY.keys()
    if not named:
        return None
    others = {FAMILY[w][(FAMILY[w].index(w) + turn) % len(FAMILY[w])] for w in named}
    return (found - named) | others


def fitted(sample: DataFrame, prior: float, sample_prior: float, bits: int, epochs: int, penalty: float) -> tuple[dict[int, float], float]:
    """Weights other than zero and the intercept, from the bounded ``sample`` (doc_id, text, toxic)."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ys, digests, versions = [], [], [], []
            for doc_id, text, y in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                found = words(text)
                forms = [found, *(s for turn in range(1, SWAPS + 1) if (s := swapped(found, turn)) is not None)]
                for to, x in ((ids, doc_id), (ys, y), (digests, md5((text or "").encode("utf-8", "replace")).digest()), (versions, [features(f, bits) for f in forms])):
                    to.append(x)
            columns = [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(ys, pa.int32()), pa.array(versions, pa.list_(pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "toxic", "versions"])

    def train(rows: pa.Table) -> pa.Table:
        # A text and its swapped versions are one row; repeated rows are learned from each.
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "digest", "toxic")])
        data = [(y, np.array(at[0], np.int64), [np.array(x, np.int64) for x in at[1:]]) for y, at in zip(*(rows.column(c).to_pylist() for c in ("toxic", "versions")), strict=True)]
        model, bias, rng = Ftrl(1 << bits, 1, alpha=0.3, l1=1.0, l2=0.5), Ftrl(1, 1, alpha=0.3, l1=0.0, l2=0.0), np.random.default_rng(7)
        zero = np.zeros(1, np.int64)
        for _ in range(epochs):
            for i in rng.permutation(len(data)):
                y, at, versions = data[i]
                w, b = model.weights(at), bias.weights(zero)
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w.sum() + b[0, 0])))))
                model.update(at, np.full_like(w, p - y), w)
                bias.update(zero, np.array([[p - y]]), b)
                for other in versions:
                    only, theirs = np.setdiff1d(at, other), np.setdiff1d(other, at)
                    w1, w2 = model.weights(only), model.weights(theirs)
                    change = 2 * penalty * float(w1.sum() - w2.sum()) / max(1, len(only) + len(theirs))
                    model.update(only, np.full_like(w1, change), w1)
                    model.update(theirs, np.full_like(w2, -change), w2)
        w = model.weights()[:, 0]
        f = np.flatnonzero(w)
        return pa.table({"feature": np.append(f, -1), "w": np.append(w[f], float(bias.weights(zero)[0, 0]))})

    vectored = sample.mapInArrow(vectors, "doc_id long, digest binary, toxic int, versions array<array<int>>")
    # The sample is bounded by a parameter, so one task fits it at any size of the corpus.
    got = vectored.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "feature long, w double").toPandas()
    weights = dict(zip(got["feature"].astype(int).tolist(), got["w"].tolist(), strict=True))
    bias = weights.pop(-1, 0.0)
    return weights, bias + math.log(prior / (1 - prior)) - math.log(sample_prior / (1 - sample_prior))


def score(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, bits: int = BITS, epochs: int = EPOCHS, penalty: float = PENALTY) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Learned from labelled rows whose crc32(doc_id) mod 4 is not 2. A null or empty text scores
    as a text without known words. Without both labels to learn from, the score is the share of
    label 1, or 0. Texts of any length are read whole, repeated rows are scored each, an empty table
    gives an empty result; other columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(fold(F.col("doc_id"), 4) != 2)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    weights, bias = {}, -30.0
    if sizes.get(0) and sizes.get(1):
        take = {y: min(1.0, per_label / sizes[y]) for y in (0, 1)}
        drawn = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) < F.when(F.col("toxic") == 1, 1_000_000 * take[1]).otherwise(1_000_000 * take[0])
        # Bounded: about per_label rows of each label are drawn before the join.
        sample = d.join(F.broadcast(known.where(drawn)), "doc_id").select("doc_id", "text", "toxic")
        kept = {y: sizes[y] * take[y] for y in (0, 1)}
        weights, bias = fitted(sample, sizes[1] / total, kept[1] / (kept[0] + kept[1]), bits, epochs, penalty)
    elif sizes.get(1):
        bias = 30.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active: dict[str, tuple[int, ...]] = {}
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                hit: set[int] = set()
                for w in words(text):
                    if (f := active.get(w)) is None:
                        if len(active) >= 300_000:
                            active.clear()
                        f = active[w] = active_features(w, weights, bits)
                    if f:
                        hit.update(f)
                z = bias + sum(weights[f] for f in sorted(hit))
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            scores = np.array(out, float)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    return d.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier predicts toxic; a null doc_id is kept."""
    return drop_ids(docs, score(docs, labels).where("predicted = 1").select("doc_id"), "toxic")
