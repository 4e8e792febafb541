"""Token alignment, URL verdicts and periodic runs against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lanternlog.llm import periodic_runs, token_alignment, url_filter
from lanternlog.llm.tokens import vocabulary_path

WORDS = re.compile("[^\x20\x09-\x0d]+")


def byte_of():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(kept)))}


def plain_alignment(texts):
    """The rows by the definition: every link of every group of whole texts."""
    a, b = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    alphabet, docs, held = byte_of(), [], Counter()
    for text in texts:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in x]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p := b.id_to_piece(i)) else p.replace("\u2581", " ").encode() for i in y]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            docs.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in bytes_a]), np.cumsum([len(p) for p in bytes_b])
        shared = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = [([], []) for _ in shared]
        for side, ids, ends in ((0, x, ends_a), (1, y, ends_b)):
            for i, e in zip(ids, ends.tolist(), strict=True):
                groups[next(k for k, s in enumerate(shared) if e <= s)][side].append(i)
        links = [(i, j) for left, right in groups for i in left for j in right]
        held.update(set(links))
        docs.append((len(x), len(y), groups, links))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    for d in docs:
        if d is None:
            yield 0, 0, 0, 0, 0, 0, ""
            continue
        n_a, n_b, groups, links = d
        listed = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        yield n_a, n_b, len(groups), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha256(listed.encode()).hexdigest()


def odd_texts(rng):
    pieces = ["The", "quick", "brown", "fox", "Straße", "niño", "œuvre", "12345", "3.14", "don't", "I'll", "a@b.com", "foo(bar);", "</s>", "<s>", "<|endoftext|>", "<unk>", "你好世界", "😀😀", "e\u0301", "x\u0300y", "----", "***", "&amp;", "aaaaaaaaaaaaaaaaaaaaaa", "ЖжЖ", "__init__", "Ŀ", "²½", "naïve!"]
    gaps = [" ", " ", " ", " ", "  ", "   ", "\n", "\n\n", " \n", "\n ", "\t", "\t\t", " \t ", "", "", "\r\n", "\x0b", "\xa0", "\u2003", "\x1c", "\x85"]
    for _ in range(300):
        yield "".join(rng.choice(pieces) + rng.choice(gaps[: rng.choice([4, 15, 21])]) for _ in range(rng.randint(1, 25)))
    yield from [" ", "  ", "\n", "\t", " a", "a ", "a  ", "\na", "a\n", "a \n", "\u2581", "a\u2581b", " \u2581", "<0x41>", "x" * 3000, "😀" * 400, "\x00", "a\x00b", "\ufeffa", "ﬁ", "word." * 300, ".", "'s", " 's", "é" * 200]


def test_alignment_is_the_definitions(spark):
    texts = [None, "", *odd_texts(random.Random(5))]
    texts += texts[5:9]  # repeated rows are documents each
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a string")
    want = {(i, *row) for i, row in enumerate(plain_alignment([t or "" for t in texts]))}
    for hot in (1, 3, 100_000):  # more pairs are hot the larger it is
        rows = token_alignment.align(docs.repartition(3), hot_pairs=hot).collect()
        got = {tuple(r) for r in rows}
        assert len(rows) == len(texts) and got == want, sorted(got ^ want)[:6]
    assert token_alignment.align(docs.limit(0)).count() == 0
    assert [tuple(r)[:2] for r in token_alignment.align(spark.createDataFrame([(None, "a")], "doc_id long, text string")).collect()] == [(None, 1)]


def test_alignment_bounds_its_memory_and_large_groups(spark, monkeypatch):
    texts = ["".join(random.Random(i).choice("ab cd!") for _ in range(200)) for i in range(40)] + ["a " * 20_000]
    want = set(plain_alignment(texts))
    monkeypatch.setattr(token_alignment, "MEMORY_UNITS", 50)
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 2)
    a, got, pairs = token_alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model"), [], []
    for k in range(0, len(texts), 7):
        for units in a.documents(texts[k : k + 7]):
            sizes, groups, direct, others, many = zip(*units, strict=True)
            got.append((*np.frombuffer(b"".join(sizes), np.int64).reshape(-1, 4).sum(0).tolist(), sha256(";".join(groups).encode()).hexdigest()))
            pairs.append(len(b"".join(direct)) // 4 + len(b"".join(others)) // 8 + sum(n for m in many for _, n in m))
    assert {(*r[:4], r[6]) for r in want} == set(got) and [g[3] for g in got] == pairs


def plain_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


ODD_URLS = [
    None, "", "nothing", "://", "http://", "http:///en/1", "HTTP://WWW.Example.COM/en/1", "http://www.example.com/EN/1", "https://a.www.example.com/en/", "https://com/", "http://com", "http://xcom/",
    "http://notexample.com/en/2", "http://a.net/es/9?x=/en/", "http://a.net?x=/es/1", "http://a.net#/es/", "http://net/fr/", "http://a.example.com/en", "http://x.org/a://b", "http://É.COM/en/", "http://casino-win.org/a\nb?c",
]


def test_rules_are_the_definitions(spark):
    rows = [(i, u, "h") for i, u in enumerate(ODD_URLS * 2)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()}
    for i, u, _ in rows:
        host, path, rule, verdict = plain_verdict(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == (verdict or ("block" if got[i]["score"] >= 0.5 else "allow")), u
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_unknown_hosts_are_told_apart(spark):
    bad = ["http://casino-palace.org/en/3", "https://m.spam-farm.example.org/de/1", "http://xxx-adult.org/", "http://pills-cheap.org/fr/2", "http://ads-track2.org/en/9", "https://freebets.org/es/1"]
    good = ["http://thornton.org/en/3", "https://m.linden.example.org/de/1", "http://www.therapy.org/", "http://villa.org/fr/2", "http://contrast.org/en/9", "https://blog.alphabet.org/es/1", "http://a.org/" + "x/y" * 3000]
    urls = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(urls).collect()}
    assert [got[i] for i in range(len(bad + good))] == ["block"] * len(bad) + ["allow"] * len(good)
    assert sorted(r["url"] for r in url_filter.without_blocked(urls).collect()) == sorted(good)
    none = spark.createDataFrame([("http://a.org/x", None), (None, 1)], "url string, blocked int")
    assert {r["score"] for r in url_filter.judge(urls, labelled=none).collect()} == {0.0}
    assert {r["score"] for r in url_filter.judge(urls, labelled=none.withColumns({"url": F.lit("http://a.org/x"), "blocked": F.lit(1)})).collect()} == {1.0}
    with pytest.raises(ValueError):
        url_filter.judge(urls, rules=(url_filter.Rule("allow", "com"),) * 1001)


def plain_runs(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text):
    words, h = WORDS.findall(text or ""), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and words:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    digests = [sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests)


def test_runs_are_the_definitions(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        n = rng.choice([0, 1, 4, 6, 7, 20, 60, 150, 400])
        words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 4, 8])]) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n >= 6 else 0):
            p, at = rng.randint(1, n // 4 + 1), rng.randrange(n)
            words[at:] = [words[at + k % p] if at + k % p < n else "z" for k in range(n - at)] if rng.random() < 0.5 else words[at:]
        rows.append((i, "".join(w + rng.choice(["", "x"]) * (n > 100) + rng.choice([" ", " ", "\t\n", "\x0b", " \r\x0c"]) for w in words)))
    rows += [(None, "a " * 9), (7, None), (7, ""), (8, " \t\n"), (9, "a\u00a0a a\u2003a " * 5), (10, "b\x1cb " * 30), *rows[:5], (11, "ä ö " * 40)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, period int")
    want = Counter(plain_report(*r) for r in rows)
    for block in (1, 500, 200_000):
        got = Counter(tuple(r) for r in periodic_runs.find_runs(docs.repartition(2), plant=True, block_words=block).collect())
        assert got == want, list((got - want))[:2] + list((want - got))[:2]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_runs_in_very_long_texts(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(50)}" for _ in range(120_000)]
    unit = [f"u{rng.randrange(9)}" for _ in range(7001)]
    words[20_000 : 20_000 + 4 * 7001 + 13] = [unit[k % 7001] for k in range(4 * 7001 + 13)]
    words[90_000:90_300] = ["a", "b", "a", "b", "c"] * 60
    words[100_000:103_000] = ["a"] * 3000
    row = periodic_runs.find_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    found = {(s, n, q) for s, n, q in periodic_runs.regions(np.unique(words, return_inverse=True)[1].astype(np.int64), np.array([len(words)])) if n >= 6}
    assert {(20_000, 4 * 7001 + 13, 7001), (90_000, 300, 5), (100_000, 3000, 1)} <= found and row["n_runs"] == len(found)
    assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (100_000, 3000, 1, 3_000_000)
