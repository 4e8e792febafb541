"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover every training document. The regression is fitted on at most
``per_label`` training documents of each language (in expectation: a hash of the id draws them)
by follow-the-regularised-leader with elastic net, then one temperature is fitted on a fifth of
them that was held back. Every text is read whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold
from .linear import Ftrl, softmax

BITS, PER_LABEL, EPOCHS = 15, 1000, 3
U = np.uint32


def letter_table() -> np.ndarray:
    """Lower-case form of each basic-plane letter, 0 for what isn't one."""
    out = np.zeros(1 << 16, U)
    for c in range(1 << 16):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Grams:
    """Hashed counts of the 1- to 3-character n-grams of a text's letters; other characters are one gap."""

    def __init__(self, bits: int = BITS):
        self.table, self.size = letter_table(), 1 << bits
        self.shift = U(32 - bits)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """(features, counts), or None for a text without a letter."""
        c = np.frombuffer((text or "").encode("utf-32-le", "replace"), U)
        low = self.table[np.minimum(c, U(0xFFFF))]
        if (big := c > 0xFFFF).any():
            low = low.copy()
            low[big] = [x if chr(x).isalpha() else 0 for x in c[big].tolist()]
        if not low.any():
            return None
        low = low[np.concatenate([[True], (low[1:] | low[:-1]) > 0])]  # a run of others is one
        with np.errstate(over="ignore"):
            one = low * U(2654435761)
            two = (one[:-1] ^ U(0x5BD1E995)) * U(2246822519) + one[1:]
            three = (two[:-1] ^ U(0x27D4EB2F)) * U(3266489917) + one[2:]
            at = np.concatenate([one, two * U(668265263), three * U(374761393)]) >> self.shift
        found = np.bincount(at, minlength=self.size)
        features = np.flatnonzero(found)
        return features, found[features]

    def vector(self, text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        counted = self.counts(text)
        if counted is None:
            return None
        features, n = counted
        x = np.log1p(n) * idf[features]
        return features, x / max(np.sqrt((x * x).sum()), 1e-12)


def document_frequencies(docs: DataFrame, bits: int) -> np.ndarray:
    """Smoothed inverse document frequency of every hashed n-gram over all of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, df, n = Grams(bits), np.zeros(1 << bits, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                if (counted := grams.counts(text)) is not None:
                    df[counted[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["feature", "n"])

    rows = docs.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # one row per hashed feature
    table = rows.set_index("feature")["n"] if len(rows) else pd.Series({-1: 0})
    df = np.zeros(1 << bits)
    known = table.index.to_numpy() >= 0
    df[table.index.to_numpy()[known].astype(int)] = table.to_numpy()[known]
    return np.log((1 + int(table.get(-1, 0))) / (1 + df)) + 1


def fitted(sample: DataFrame, labels: list[str], idf: np.ndarray, bits: int, epochs: int) -> tuple[np.ndarray, float]:
    """Weights (feature by label) and temperature from the bounded ``sample`` (text, lang, held, doc_id), in the order of doc_id and text."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for b in batches:
            given = zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)
            rows = [(i, md5(text.encode("utf-8", "replace")).digest(), lang, held, *v) for text, lang, held, i in given if (v := grams.vector(text, idf)) is not None]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.binary(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.float32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "digest", "lang", "held", "at", "x"])

    def train(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "digest", "lang")])
        where = {label: i for i, label in enumerate(labels)}
        data = [(where[l], h, np.array(a), np.array(x, float)) for l, h, a, x in zip(*(rows.column(c).to_pylist() for c in ("lang", "held", "at", "x")), strict=True)]
        order = np.random.default_rng(7).permutation(len(data))
        model = Ftrl(1 << bits, len(labels), alpha=1.0, l1=0.05, l2=0.1)
        eye = np.eye(len(labels))
        for _ in range(epochs):
            for i in order:
                y, held, at, x = data[i]
                if not held:
                    w = model.weights(at)
                    model.update(at, x[:, None] * (softmax(x @ w) - eye[y]), w)
        w = model.weights()
        scores = [(y, x @ w[at]) for y, held, at, x in data if held] or [(y, x @ w[at]) for y, _, at, x in data]
        temperatures = np.geomspace(0.05, 5, 60)
        loss = [-sum(np.log(softmax(s / t)[y] + 1e-12) for y, s in scores) for t in temperatures]
        f, k = np.nonzero(w)
        return pa.table({"feature": np.append(f, -1), "label": np.append(k, -1), "w": np.append(w[f, k], temperatures[int(np.argmin(loss))])})

    vectored = sample.mapInArrow(vectors, "doc_id long, digest binary, lang string, held boolean, at array<int>, x array<float>")
    # The sample is bounded by a parameter, so one task fits it at any size of the corpus.
    got = vectored.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "feature long, label long, w double").toPandas()
    w, temperature = np.zeros((1 << bits, len(labels))), 1.0
    for f, k, v in got.itertuples(index=False):
        if f < 0:
            temperature = v
        else:
            w[int(f), int(k)] = v
    return w, temperature


def identify(docs: DataFrame, per_label: int = PER_LABEL, bits: int = BITS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``.

    Learned from text and lang of rows whose crc32(doc_id) mod 3 is not 1 and whose lang is not
    null. A text that is null or has no letter is ``und`` with score 0; with nothing to learn
    from all are. Equal scores go to the label that sorts first. Texts of any length
    are read whole, repeated rows are predicted each, an empty table gives an empty result; other
    columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    d = d.withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    train = d.where("not held_out and lang is not null")
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}  # one row per language
    labels = sorted(sizes)
    if labels:
        idf = document_frequencies(train, bits)
        drawn = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1_000_000))
        rate = F.create_map(*[F.lit(x) for k in labels for x in (k, 1_000_000 * per_label / sizes[k])])
        sample = train.where(drawn < rate[F.col("lang")]).select("text", "lang", (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0).alias("held"), "doc_id")
        weights, temperature = fitted(sample, labels, idf, bits, epochs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for b in batches:
            names, scores = [], []
            for text in b.column("text").to_pylist():
                v = grams.vector(text, idf) if labels else None
                if v is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                p = softmax(v[1] @ weights[v[0]] / temperature)
                names.append(labels[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return d.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")

