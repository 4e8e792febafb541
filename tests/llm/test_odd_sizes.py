"""Very long texts, empty tables, texts without a place to cut, and the stages of the pipeline against plain Python."""

import hashlib
import random
import re
import shutil
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lanternlog.llm import chunk_dedup, jaccard_join, langid, lattice_lm, packing, pii, token_shards, toxicity
from lanternlog.llm.tokens import vocabulary_path

ALPHABET = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "an", "el")]


def prose(rng, n):
    return " ".join(rng.choice(ALPHABET) + rng.choice(ALPHABET) for _ in range(n))


@pytest.fixture(scope="module")
def long_text():
    return prose(random.Random(1), 120_000)


def test_exact_groups_of_texts_without_a_place_to_cut(spark, long_text):
    rng = random.Random(2)
    texts = ["é" * 5000, "é" * 4999 + "e", "é" * 5000, "语" * 4096, "语" * 4097, "a" * 4096 + "b", "a" * 4096 + "c", "😀" * 3000, "😀" * 3000, long_text, long_text + ".", long_text, "x" * 511 + ". y", ". " * 900, ". " * 900, "\n" * 5000, "\n" * 5001]
    texts += [prose(rng, 400).replace(" ", "。 " if i % 2 else "\n") for i in range(4)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for low, high in ((512, 4096), (1, 7), (3, 50)):
        part = docs if high > 50 else docs.where("doc_id not in (9, 10, 11)")
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in chunk_dedup.exact_groups(part, low, high).collect()}
        held = [(i, t) for i, t in enumerate(texts) if i in got]
        for i, t in held:
            same = [j for j, u in held if u == t]
            assert got[i] == (max(same), len(same), i == max(same), hashlib.sha256(t.encode()).hexdigest())
        cut = part.select("doc_id", F.regexp_extract_all("text", F.lit(chunk_dedup.chunk_pattern(low, high)), F.lit(0)).alias("c")).collect()
        assert all("".join(r["c"]) == texts[r["doc_id"]] and max(map(len, r["c"])) <= high + 2 for r in cut)


def test_spans_of_a_very_long_text(spark, long_text):
    text = f"{long_text} mail a.b@example.com {long_text} 4111 1111 1111 1111 é {long_text} 10.0.0.1"
    row = pii.span_digest(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").first()
    want = [f"{kind}:{m.start()}:{m.end()}" for kind, p in (("email", r"a\.b@example\.com"), ("card", "4111 1111 1111 1111"), ("ip", r"10\.0\.0\.1")) for m in re.finditer(p, text)]
    assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest() and (row["n_email"], row["n_card"], row["n_ip"], row["n_phone"]) == (1, 1, 1, 0)


def test_long_texts_and_empty_tables_of_the_classifiers(spark, long_text):
    rng = random.Random(3)
    rows = [(i, prose(rng, 20) + (" vileword" if i % 3 == 0 else ""), "en" if i % 2 else "de") for i in range(90)] + [(200, long_text + " vileword", "en"), (201, long_text, "en"), (202, "", None), (203, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert got[200]["score"] > got[201]["score"] and got[202]["score"] == got[203]["score"] and set(got) == {r[0] for r in rows}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert toxicity.score(docs.limit(0), labels).count() == 0 and toxicity.score(docs, labels.limit(0)).count() == len(rows)
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert found[201]["lang_pred"] in ("en", "de") and found[202]["lang_pred"] == found[203]["lang_pred"] == "und" and langid.identify(docs.limit(0)).count() == 0


def test_scores_are_those_of_the_weights(spark):
    """The score by plain Python, from the weights that were fitted."""
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, prose(rng, 15) + (" vileword awful" if i % 4 == 0 else "")) for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int")
    sample = docs.join(labels, "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2").select("doc_id", "text", F.col("toxic").cast("int"))
    share = sample.agg(F.avg("toxic")).first()[0]
    weights, bias = toxicity.fitted(sample, share, share, toxicity.BITS, toxicity.EPOCHS, toxicity.PENALTY)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels).collect()}
    for r in docs.collect():
        hit = set().union(*(toxicity.word_features(w, toxicity.BITS) for w in toxicity.words(r["text"])))
        z = bias + sum(weights.get(f, 0.0) for f in hit)
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-z))) < 1e-9


def test_shards_of_a_very_long_text(spark, long_text, tmp_path):
    texts = [long_text, "short", None, long_text]
    path = str(tmp_path / "shards")
    rows = token_shards.write_shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), path, seed=5, shard_slots=16).collect()
    whole = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    n = 1 + max(r["slot"] for r in rows)
    stored = np.stack(list(token_shards.read_slots(path, 0, n, shard_slots=16)))
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, packing.END_ID])
        parts = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        back = [stored[r["slot"]][(r["byte_offset"] % 2048) // 2 :][: r["length"]] for r in parts]
        assert np.array_equal(np.concatenate(back), ids) and len(parts) > 1 - (len(ids) < 9)
    assert token_shards.write_shards(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), seed=5).count() == 0


def test_near_copies_of_very_long_texts(spark, long_text):
    words = long_text.split()
    other = list(words)
    for i in range(0, len(words), 400):
        other[i] = "changed"
    far = list(words)
    for i in range(0, len(words), 12):
        far[i] = f"n{i}"
    rows = [(1, long_text), (2, " ".join(other)), (3, " ".join(far)), (4, " ".join(words[:119_000])), (5, "one two"), (6, "one two three")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 3).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6}


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_equals_plain_python(spark, tmp_path, long_text):
    """All stages but the classifier and the packing's layout: which documents are left, in plain Python."""
    import corpus_pipeline

    rng = random.Random(8)
    item = prose(rng, 24)
    rows = [(i, prose(rng, rng.choice([3, 30, 60])) + (" vileword vileword" if i < 90 and i % 3 == 0 else "")) for i in range(120)]
    base = prose(rng, 70).split()
    for i in range(12):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(70)] = "zz"
        rows.append((300 + i, " ".join(copy)))
    rows += [(400 + i, rows[i + 91][1]) for i in range(5)] + [(500, prose(rng, 20) + " " + item), (501, item), (502, " ".join(item.split()[:8])), (600, long_text), (601, long_text + " end"), (700, None), (701, "")]
    spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.score(table, labels).where("predicted = 1").collect()}
    left = {i: t or "" for i, t in rows if i not in toxic}
    last = {t: i for i, t in sorted(left.items())}
    left = {i: t for i, t in left.items() if last[t] == i}
    sets, label = {i: shingles(t) for i, t in left.items()}, {i: i for i in left}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in label:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    left = {i: t for i, t in left.items() if label[i] == i}
    windows = [item.split()[k : k + 5] for k in range(20)]
    held = lambda t: sum(f" {' '.join(w)} " in f" {t} " for w in windows)
    left = {i for i, t in left.items() if held(t) < 10}
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == left
    assert {i for i in range(90) if i % 3 == 0} <= toxic and {500, 501} & left == set() and {502, 600} <= left | toxic
    # Tables without rows.
    none = tmp_path / "none"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{none}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(none)).count() == 0
    shutil.rmtree(none / "benchmark.parquet")
    shutil.copytree(tmp_path / "benchmark.parquet", none / "benchmark.parquet")
    assert corpus_pipeline.run(spark, str(none)).count() == 0


def test_context_by_the_definition():
    """Each word's probability from counts so far, in logarithms and one by one, also where probabilities are below any number."""
    rng = random.Random(6)
    for n, words in ((0, 1), (1, 1), (40, 6), (300, 30)):
        at = np.array([rng.randrange(words) for _ in range(n)], np.int64)
        lp = np.array([rng.choice([-1.0, -9.5, -700.0, -3000.0]) for _ in range(words)])
        priors, totals = ((3.0, 70.0), (2.0, 900.0)), []
        for mu in priors[0]:
            for nu in priors[1]:
                total = 0.0
                for i, w in enumerate(at.tolist()):
                    before = [x for k, x in enumerate(at[:i].tolist()) if k and at[k - 1] == at[i - 1]] if i else []
                    starts = int((at[: i - 1] == at[i - 1]).sum()) if i else 0
                    n_before = int((at[:i] == w).sum())
                    one = np.logaddexp(np.log(n_before) if n_before else -np.inf, lp[w] + np.log(mu)) - np.log(i + mu)
                    pairs = before.count(w)
                    total += np.logaddexp(np.log(pairs) if pairs else -np.inf, one + np.log(nu)) - np.log(starts + nu)
                totals.append(total)
        want = np.logaddexp.reduce(totals) - np.log(4) if n else 0.0
        assert abs(lattice_lm.in_context(at, lp[at], priors) - want) < 1e-6 * max(1, abs(want))


def test_blocks_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(7)
    sizes = [rng.choice([10, 100, 300]) for _ in range(3000)] + [20_000] * 40 + [rng.choice([5, 60_000, 200_000]) for _ in range(60)] + [50] * 500
    spark.createDataFrame([(i, "x" * n) for i, n in enumerate(sizes)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    for limit in (20_000, 100_000, 1_000_000):
        held = lattice_lm.with_blocks(docs, limit).groupBy("block").agg(F.sum(F.length("text")).alias("bytes"), F.count("*").alias("n")).collect()
        assert sum(r["n"] for r in held) == len(sizes)
        assert all(r["bytes"] <= lattice_lm.LONG * limit or r["n"] == 1 for r in held)


def test_repeatable_shards_hang_on_the_rows_alone(spark, tmp_path):
    rng = random.Random(9)
    texts = [prose(rng, rng.choice([0, 1, 40, 700, 2500])) for _ in range(150)] + [None, "", "same", "same"]
    rows = [(i if i < 152 else 152, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "other text of three")]
    whole, seen = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json")), []
    for parts in (2, 5, 11):
        rng.shuffle(rows)
        path = str(tmp_path / f"p{parts}")
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = token_shards.write_shards(docs, path, seed=11, length=256, shard_slots=8, repeatable=True).collect()
        n = 1 + max(r["slot"] for r in got)
        stored = np.stack(list(token_shards.read_slots(path, 0, n, length=256, shard_slots=8)))
        seen.append((sorted(map(str, got)), stored.tobytes()))
        ids = sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
        assert n == -(-ids // 256) and sum(r["length"] for r in got) == ids  # the last sequence alone is padded
        for r in got:
            at = (r["byte_offset"] % 512) // 2
            assert token_shards.crc(stored[r["slot"]][at : at + r["length"]]) == r["ids_crc32"]
    assert seen[0] == seen[1] == seen[2]
    assert token_shards.write_shards(docs.limit(0), str(tmp_path / "none"), seed=5, repeatable=True).count() == 0


def test_expected_uses_by_numbers_and_by_logarithms():
    rng = random.Random(4)
    lattice = lattice_lm.Lattice()
    words = [prose(rng, 1) + rng.choice(["", ".", "ing", "ЖЖ", "7", "é"]) for _ in range(300)] + ["语" * 40, "😀" * 30, "Ж" * 200, "a" * 900, "", "x"]
    got, want = lattice.expected(words, lattice.start), np.zeros(lattice.size + 1)
    for _, points in lattice.by_length(words):
        want += lattice.expected_by_logarithms(points, np.append(lattice.start, -np.inf))
    assert np.allclose(got, want[:-1], rtol=1e-9, atol=1e-12) and got.sum() > 600
