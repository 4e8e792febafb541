"""Operators against brute force on small tables with nulls, empty texts, ties, repeats and extra columns."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lanternlog.llm import chunk_dedup, decontaminate, html_content, jaccard_join, langid, lattice_lm, packing, pii, token_shards, toxicity
from lanternlog.llm.common import materialize
from lanternlog.llm.tokens import UnitTokenizer, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, text_sha256 string"


def words(rng, n):
    return " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) + rng.choice(["ra", "to", "ne", "li"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    base = words(rng, 120)
    rows = [(i, words(rng, rng.choice([1, 3, 30, 200])) + (" moron" if i % 3 == 0 else ""), "en") for i in range(60)]
    rows += [(100 + i, " ".join(w if rng.random() > 0.01 else "zz" for w in base.split()), "en") for i in range(12)]
    rows += [(200, base, "en"), (201, base, "en"), (202, None, None), (203, "", "en"), (204, "  ", "en"), (None, base, None), (205, base + " ", "en"), (200, base, "en")]
    return spark.createDataFrame([(*r, "s", True, "x") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("bits", [64, 1])
def test_exact_groups(docs, empty, bits):
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    want = sorted((str(r["doc_id"]), str(max(x for x in groups[r["text"] or ""] if x is not None)), len(groups[r["text"] or ""]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows)
    got = chunk_dedup.exact_groups(docs, id_bits=bits).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    assert chunk_dedup.exact_groups(empty).count() == 0


@pytest.mark.parametrize("k,percent,steps", [(3, 90, 3), (5, 80, 2), (2, 60, 1)])
def test_similarity_groups(docs, k, percent, steps):
    sets = {}
    for r in docs.where("doc_id is not null").collect():
        w = (r["text"] or "").lower().split()
        sets[r["doc_id"]] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got = jaccard_join.similarity_groups(docs, k, percent, steps).where("doc_id is not null").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), label[i]) for i in sets}


def test_ids_with_several_texts(spark):
    rng = random.Random(8)
    a, b, c = (words(rng, 60) for _ in range(3))
    near_a, near_b = a + " ra", b + " to"

    def table(rows):
        return spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")

    def left(df):
        return sorted((str(r["doc_id"]), r["text"]) for r in df.collect())

    exact = table([(9, a), (7, a), (7, b), (5, c), (5, c), (None, c), (3, None), (4, "")])
    assert left(chunk_dedup.keep_one(exact)) == sorted([("9", a), ("7", b), ("5", c), ("None", c), ("4", "")])
    near = table([(5, a), (7, near_a), (7, b), (8, near_b), (9, c), (9, c + " x"), (None, a)])
    assert left(jaccard_join.keep_one(near)) in (sorted([("5", a), ("7", b), ("9", t), ("None", a)]) for t in (c, c + " x"))
    same = table([(5, a), (7, a), (7, b), (8, near_b), (3, c)])
    assert left(jaccard_join.keep_one(same)) == sorted([("5", a), ("7", b), ("3", c)])
    assert sorted((r[0], r[2]) for r in jaccard_join.similarity_groups(same).collect()) == [(3, 3), (5, 5), (7, 5), (7, 7), (8, 7)]


def test_any_two_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for percent, steps in ((90, 3), (80, 2)):
        bands = jaccard_join.Bands(percent, steps)
        for n in (*range(1, 40), 77, 150, 400):
            r = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            most = (100 - percent) * n // 100
            s = np.sort(rng.permutation(r)[: n - most])
            (a, x), (b, y) = jaccard_join.signatures(r, bands), jaccard_join.signatures(s, bands)
            assert len(np.intersect1d(a, b)) > max(0, min(x, y))


def test_packing(docs, empty):
    rows = packing.packed_documents(docs, capacity=64).collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.packed_documents(empty).count() == 0
    lengths = np.array([33, 33, 33, 10, 10, 10, 31, 31, 31])
    places = {(r["doc_id"], r["piece"]): r for r in rows if r["doc_id"] not in (None, 200)}
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    for d in docs.where("doc_id is not null and doc_id <> 200").collect():
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        cuts = [ids[i : i + 64] for i in range(0, len(ids), 64)]
        for i, part in enumerate(cuts):
            r = places.pop((d["doc_id"], i))
            assert (r["start"], r["length"], r["ids_crc32"]) == (64 * i, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert not places
    assert packing.lower_bound(lengths, 64) == 4 and packing.lower_bound(np.array([40, 40, 40]), 64) == 3


def test_partitions_with_gaps_exchange(spark):
    rng = random.Random(1)
    pieces = spark.createDataFrame([(i, 0, rng.choice([40, 30, 21])) for i in range(400)], "doc_id long, piece int, length long")
    rows = packing.pack(pieces, capacity=64, group_pieces=40).collect()
    assert len(rows) == 400 and len({r["round"] for r in rows}) > 1
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 64


def test_shards_round_trip(docs, empty, tmp_path):
    n = 1000
    assert sorted(token_shards.feistel(np.arange(n), n, 9).tolist()) == list(range(n)) and token_shards.feistel(np.arange(1), 1, 9).tolist() == [0]
    first = None
    for run in ("a", "b"):
        path = tmp_path / run
        rows = token_shards.write_shards(docs, str(path), seed=5, length=16, shard_slots=8).collect()
        slots = {r["slot"] for r in rows}
        assert slots == set(range(len(slots))) and {p.name for p in path.iterdir()} == {f"shard-{i:08d}.u16" for i in range(-(-len(slots) // 8))}
        blocks, whole = dict(enumerate(token_shards.read_slots(str(path), 0, len(slots) + 5, 16, 8))), {}
        assert len(blocks) == len(slots) and [b.tolist() for b in token_shards.read_slots(str(path), 3, 7, 16, 8)] == [blocks[i].tolist() for i in range(3, 10)]
        for r in rows:
            at = (r["byte_offset"] - r["slot"] % 8 * 32) // 2
            ids = blocks[r["slot"]][at : at + r["length"]]
            assert token_shards.crc(ids) == r["ids_crc32"] and r["shard"] == r["slot"] // 8
            whole.setdefault(r["doc_id"], []).append((r["start"], r["piece"], ids.tolist()))
        tokenizer = UnitTokenizer()
        for r in docs.collect():
            want = np.frombuffer(next(tokenizer.ids([r["text"]])), "<u2").tolist() + [1]
            if r["doc_id"] not in (None, 200):  # these ids repeat
                parts = sorted(whole[r["doc_id"]])
                assert sum((p[2] for p in parts), []) == want and [p[1] for p in parts] == list(range(len(parts)))
        first = first or sorted(map(str, rows))
        assert sorted(map(str, rows)) == first  # resumed or repeated runs write the same
    assert token_shards.write_shards(empty, str(tmp_path / "none"), seed=5).count() == 0


def test_leaks_and_their_slots(spark):
    item = "The farmer sold 12 apples and 30 pears to Alice for 5 dollars before the market closed"
    other = item.replace("12", "47").replace("30", "8").replace("Alice", "Robert").replace("5 dollars", "9 euros")
    rows = [(1, "Start here. " + item + " and so on"), (2, "x y z " + other), (3, "nothing of the kind is told in this text at all"), (4, None), (5, ""), (1, item)]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item, 1), (7, item, 1), (8, None, 1), (9, "short", 1)], "item_id long, text string, doc_id int")
    got = decontaminate.find_leaks(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 7), (2, 7)}
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0


def test_item_and_its_variant_in_one_document(spark):
    item = "The farmer sold 12 apples and 30 pears to Alice for 5 dollars before the market closed"
    other = item.replace("12", "47").replace("30", "8").replace("Alice", "Robert").replace("5 dollars", "9 euros")
    third = other.replace("47", "61").replace("Robert", "Wanda").replace("8", "77")
    longer = item.replace("pears", "very ripe pears")
    chance = " Then a clerk wrote. The farmer sold 99 apples at noon."
    rows = [(1, item + ". Later on: " + other), (2, other + " " + third), (3, longer + chance), (4, item + chance), (5, "The farmer sold 12 apples and went home"), (6, item), (6, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == {1, 2, 3, 4, 6}
    assert all(got[i]["coverage"] == 1 and got[i]["slot_consistency"] == 1 for i in (1, 2, 4, 6)) and 0.5 <= got[3]["coverage"] < 1
    assert decontaminate.without_leaks(docs, items).select("doc_id").collect() == [(5,)]


def test_spans(spark):
    text = "😀 mail a.b@c.de, ip 10.0.0.1 and 999.1.1.1, card 4111 1111 1111 1111, call +1 (555) 555-1234; iban GB82 WEST 1234 5698 7654 32 a@b.c%d@e.f"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (1, text)], "doc_id long, text string")
    got = pii.span_digest(df).collect()
    assert [tuple(r)[1:5] for r in got] == [(3, 1, 1, 1), (0, 0, 0, 0), (0, 0, 0, 0), (3, 1, 1, 1)]
    assert got[0]["spans"].startswith("email:7:15,ip:20:28,card:") and "iban:" in got[0]["spans"] and got[1]["spans"] == ""
    assert "4111" not in pii.mask(df).first()["text"]


def test_ibans_before_capitals(spark):
    def check_digits(country, rest):
        return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02}"

    plain, spaced, other = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", f"ZZ{check_digits('ZZ', '123456789012')} 1234 5678 9012"
    texts = {
        f"{plain} today": [plain], f"Konto {plain} Bitte": [plain], f"IBAN {spaced} BIC COBADEFFXXX": [spaced], f"({spaced}) A {plain} B2": [spaced, plain],
        f"{spaced} {plain} GB82 WEST 1234 5698 7654 32 AND NO93 8601 1117 947 X": [spaced, plain, "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"],
        f"{other} BIC ABCD Then": [other], f"x{plain} {plain}B DE89 3704 0044 0532 0130 01 Bitte {plain[:-1]} Bitte": [], f"😀 {spaced} Danke": [spaced],
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r, (text, want) in zip(pii.find_spans(df).orderBy("doc_id").collect(), texts.items()):
        assert [s["match"] for s in r["pii"] if s["kind"] == "iban"] == want == [text[s["start"] : s["end"]] for s in r["pii"] if s["kind"] == "iban"]
    assert pii.mask(df).where("doc_id = 2").first()["text"] == "IBAN [IBAN] BIC COBADEFFXXX"


def test_lattice_sums_all_segmentations(docs):
    lattice = lattice_lm.Lattice()
    word, logp = "the", np.append(lattice.start, -np.inf)

    def total(s):
        if not s:
            return 1.0
        return sum(np.exp(logp[lattice.find(np.array([h], np.uint64))[0]]) * total(s[n:]) for n in range(1, len(s) + 1) for h in [plain(s[:n])])

    def plain(piece):
        h = 0
        for c in piece:
            h = (h * 0x100000001B3 + ord(c) + 1) & (1 << 64) - 1
        return h

    assert lattice.log_probability([word], lattice.start)[0] == pytest.approx(np.log(total("▁" + word)))
    rows = lattice_lm.score_documents(docs, rounds=1).collect()
    assert len(rows) == docs.count() and all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_words_in_context_sum_to_one():
    p = np.array([0.5, 0.3, 0.2])
    total = sum(np.exp(lattice_lm.in_context(np.array(t), np.log(p[list(t)]))) for t in itertools.product(range(3), repeat=4))
    assert total == pytest.approx(1) and lattice_lm.in_context(np.empty(0, np.int64), np.empty(0)) == 0
    again = lattice_lm.in_context(np.array([2, 1] * 20), np.log(p[[2, 1] * 20]))
    assert again > np.log(p[[2, 1] * 20]).sum() and lattice_lm.earlier(np.array([7, 3, 7, 7, 3])).tolist() == [0, 0, 1, 2, 1]


def test_pages(spark):
    page = "<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><ul><li><a>menu</a></li></ul></nav><article><h1>Head</h1><p>One &amp; two\n three <b>bold<p>Four five six seven</article><div class='comments'><p>nice text here</div><footer>f</footer>"
    df = spark.createDataFrame([(1, "u", page, "x"), (2, "v", None, "x"), (3, None, "", "x")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_content.extract(df).collect()}
    assert got == {1: "Head\n\nOne & two three bold\n\nFour five six seven", 2: "", 3: ""}


def test_hints_do_not_take_the_article():
    body = " ".join(f"<p>{'plain words of an article ' * 6}{i}</p>" for i in range(4))
    ad, want = '<div class="ad">buy now</div>', [f"{'plain words of an article ' * 6}{i}" for i in range(4)]
    pages = [
        f'<body><nav>menu</nav><div class="layout has-sidebar"><article>{body}</article></div><footer>f</footer>',
        f'<body><div class="sidebar"><main>{body}{ad}</main></div><div class="comments">nice</div>',
        f'<body id="no-comments"><div id="no-comments"><article>{body}</article></div>',
        f'<body><div class="widget">{body}</div>{ad}',
        f'<body><article>{ad}<div class="widget">{body}</div></article><div class="comments"><article class="comment">nice</article></div>',
        "<body><article>" + body.replace("<p>", '<div class="elementor-widget x"><p>').replace("</p>", "</p></div>") + "</article>",
        "<body><article>" + body.replace("<p>", '<p title="the hidden story" data-x="a role=search class=ad">') + "</article>",
    ]
    for page in pages:
        assert html_content.main_text(page, html_content.DEFAULT_WEIGHTS).split("\n\n") == want, page
    formula = f"<article>{body}<p>So <math><mi>x</mi> <mo>=</mo> <mn>2</mn><annotation>x=2</annotation></math> holds</p></article>"
    assert html_content.main_text(formula, html_content.DEFAULT_WEIGHTS).endswith("\n\nSo x = 2 holds")


def test_pages_without_spaces(spark):
    chinese, thai, japanese = "今天的新闻说,这座城市的春天来得很早。人们都在公园里散步。" * 3, "วันนี้อากาศดีมากและทุกคนออกไปเดินเล่น" * 3, "今日はとても良い天気なので、みんなで公園を歩きました。" * 3
    around = "<html><body><nav>menu</nav>{}<p>Copyright by the owners of this page in 2024</p></body></html>"
    inner = "<article><p>{0}一</p><div class='ad'>广告</div><p>{0}二</p><form>x</form><p>{0}三</p></article>"
    pages = [(i, "u", around.format(inner.format(text))) for i, text in enumerate((chinese, thai, japanese))]
    got = html_content.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).orderBy("page_id").collect()
    for r, text in zip(got, (chinese, thai, japanese)):
        assert r["text"] == f"{text}一\n\n{text}二\n\n{text}三"
        plain = html_content.main_text(pages[r["page_id"]][2], html_content.DEFAULT_WEIGHTS)
        assert plain.startswith(r["text"])
    assert [html_content.n_words(x) for x in ("", "a - b", "你好。", "Über uns", "用 Spark 3 做", "한국어 문장", "ไทย")] == [0, 3, 2, 2, 4, 2, 3]


def test_classifiers_on_odd_rows(spark, docs, empty):
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert found[202]["lang_pred"] == "und" and found[204]["lang_pred"] == "und" and found[1]["lang_pred"] == "en"
    assert langid.identify(empty).count() == 0
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "z") for i in range(60)] + [(None, 1, "z"), (1, None, "z")], "doc_id long, toxic int, text string")
    got = toxicity.score(docs, labels).collect()
    assert all((r["predicted"] == 1) == (r["score"] >= 0.3) for r in got) and {r["doc_id"] for r in got if r["predicted"]} >= {i for i in range(0, 60, 3)}
    assert toxicity.score(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.swapped({"a", "gay"}, 1) == {"a", "straight"} and toxicity.swapped({"a"}, 1) is None


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    item = "The farmer sold 12 apples and 30 pears to Alice for 5 dollars before the market closed"
    rows = [(i, words(rng, 80) + (" moron" if i < 60 and i % 3 == 0 else "")) for i in range(60)]
    copied, near = words(rng, 80), words(rng, 80)
    rows += [(100, copied), (101, copied), (110, near), (111, near + " ra"), (120, item.replace("12", "47")), (130, None), (131, ""), (None, words(rng, 80))]
    spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    # So small a sample says nothing of texts unlike its own: the other stages get all that isn't toxic.
    clean = corpus_pipeline.drop_toxic(spark, table, str(tmp_path)).where("doc_id < 60").collect()
    assert all(r["doc_id"] % 3 for r in clean) and len(clean) > 30
    table = table.where("doc_id is null or doc_id >= 60 or doc_id % 3 > 0")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        before = {r[0] for r in table.select("doc_id").collect()}
        table = materialize(stage(spark, table, str(tmp_path)), name)
        seen[name] = before - {r[0] for r in table.select("doc_id").collect()}
    assert seen == {"exact_dedup": {100, 130}, "near_dedup": {111}, "decontaminate": {120}}
    packed = corpus_pipeline.pack(spark, table, str(tmp_path))
    assert {r[0] for r in packed.select("doc_id").collect()} <= {r[0] for r in table.select("doc_id").collect()}
