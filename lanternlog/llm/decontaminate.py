"""Benchmark decontamination by template windows, in DataFrame functions only.

A text becomes a list of typed tokens: numbers, units and names turn into ``<n>``, ``<u>`` and
``<p>`` (units: after a number; names: capitalised words inside a sentence), other words are lower-cased and lose their
punctuation. Windows of ``window`` template tokens of the benchmark items are hash-joined with
all windows of the documents; windows that are nearly all slots go by their values. The rarer half of
an item's windows name the documents it is held against; all its windows then give the
alignments with each of them. There the item and the document are compared token by token, at every window, and the
values behind equal slots must form a consistent renaming. That is asked of each alignment, of each
run of neighbouring alignments (words put in or left out shift the rest) and of all of them
together, so a second copy with other values elsewhere in the document hides nothing.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, drop_ids, let, materialize, scratch, whole_text

# Unit words, longest first within a family.
UNITS = (
    "kilometers|kilometres|kilometer|kilometre|centimeters|centimetres|meters|metres|meter|metre|miles|mile|inches|inch|feet|foot|yards|yard|km|cm|mm|"
    "kilograms|kilogram|grams|gram|pounds|pound|ounces|ounce|tons|ton|kg|mg|lb|lbs|oz|liters|litres|liter|litre|gallons|gallon|ml|"
    "seconds|second|minutes|minute|hours|hour|days|day|weeks|week|months|month|years|year|"
    "dollars|dollar|euros|euro|cents|cent|percent|degrees|degree|usd|eur|mph|kmh|watts|watt|volts|volt"
)
#: Marks that stand alone after canonicalisation, so a slot can't be mistaken for a word.
NUMBER, UNIT, NAME = "\u0001", "\u0002", "\u0003"
#: Tokens of the shortest item that is looked for.
SHORTEST = 3


def canon_tokens(text: Column) -> Column:
    """Typed tokens: letter runs in lower case, numbers (with inner separators), units and names as marks."""
    held = [F.contains(text, F.lit(m)) for m in (NUMBER, UNIT, NAME)]
    t = F.when(held[0] | held[1] | held[2], F.translate(text, NUMBER + UNIT + NAME, "   ")).otherwise(text)
    t = F.regexp_replace(t, r"[0-9]+(?:[.,:/][0-9]+)*", f" {NUMBER} ")
    # A name: a capital and small letters after a word or comma, so inside a sentence.
    t = F.regexp_replace(t, rf"[ ]\p{{Lu}}(?<=[\p{{Ll}}{NUMBER},;][ ]\p{{Lu}})\p{{Ll}}[\p{{L}}\p{{M}}]*", " " + NAME)
    t = F.regexp_replace(F.lower(t), rf"{NUMBER}[^\p{{L}}\p{{M}}{NUMBER}{NAME}]*(?:{UNITS})(?![\p{{L}}\p{{M}}])", f"{NUMBER} {UNIT}")
    return F.array_remove(F.split(t, rf"[^\p{{L}}\p{{M}}{NUMBER}{UNIT}{NAME}]+"), "")


def raw_tokens(text: Column) -> Column:
    """The values behind ``canon_tokens``, one for one."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[0-9]+(?:[.,:/][0-9]+)*|[\p{L}\p{M}]+"), F.lit(0))


def with_tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("canon", canon_tokens(whole_text())).withColumn("raw", raw_tokens(whole_text()))


def is_slot(token: Column) -> Column:
    return token.isin(NUMBER, UNIT, NAME)


def template_hashes(canon: Column, window: int) -> Column:
    """Hash of the template of each window of ``canon``, in order; each token is hashed once."""
    starts = F.sequence(F.lit(0), F.size(canon) - window)
    return let(F.transform(canon, lambda t: F.xxhash64(t)), lambda h: F.transform(starts, lambda p: F.xxhash64(*[F.get(h, p + i) for i in range(window)])))


def values_hash(raw: Column, start: Column, window: int) -> Column:
    return F.xxhash64(F.lit("values"), F.slice(raw, start, window))


def wordless(canon: Column, window: int, literals: int) -> Column:
    """Starts of the windows with fewer than ``literals`` plain words (``3 + 4 * 5``); few texts have any, which one look at their slots tells."""
    slots, least = F.transform(canon, lambda t: is_slot(t).cast("int")), window - literals + 1
    forms = "|".join("".join("1" if i in at else "." for i in range(window)) for at in combinations(range(window), least))
    starts = F.sequence(F.lit(1), F.size(canon) - window + 1)
    some = let(slots, lambda s: F.filter(starts, lambda p: reduce(lambda a, b: a + b, [F.get(s, p + i) for i in range(-1, window - 1)]) >= least))
    return F.when(F.array_join(slots, "").rlike(forms), some).otherwise(F.expr("cast(array() as array<int>)"))


def item_windows(items: DataFrame, window: int, literals: int) -> DataFrame:
    """(hash, item_id, item_pos, naming) of all windows of items of ``window`` tokens or more.

    An item's first word may look like a name inside a document, so windows that begin with it are
    there in both readings. ``naming`` windows tell which documents are held against an item: of the windows
    with enough plain words those that fewest other items have, half of them and one more, and as
    many of the others. A document that holds half of either kind holds one of these; wording that
    many items share names no pair as long as an item has more of its own.
    """
    starts = F.sequence(F.lit(1), F.size("canon") - window + 1)
    at = items.where(F.size("canon") >= window).select("item_id", "canon", "raw", F.col("capital"), F.explode(starts).alias("item_pos"))
    as_name = F.concat(F.array(F.lit(NAME)), F.slice("canon", 2, F.size("canon")))
    forms = F.when((F.col("item_pos") == 1) & F.col("capital"), F.array("canon", as_name)).otherwise(F.array("canon"))
    at = at.select("item_id", "item_pos", "raw", F.explode(forms).alias("canon"))
    worded = F.size(F.filter(F.slice("canon", F.col("item_pos"), window), lambda t: ~is_slot(t))) >= literals
    key = F.when(worded, F.get(template_hashes(F.slice("canon", F.col("item_pos"), window), window), F.lit(0))).otherwise(values_hash(F.col("raw"), F.col("item_pos"), window))
    at = at.select("item_id", "item_pos", worded.alias("worded"), key.alias("hash"))
    common = at.groupBy("hash").agg(F.count_distinct("item_id").alias("n_items"))
    per_place = at.join(common, "hash").groupBy("item_id", "item_pos").agg(F.collect_set("hash").alias("hashes"), F.min("n_items").alias("n_items"), F.max("worded").alias("worded"))
    kind = Window.partitionBy("item_id", "worded")
    ranked = per_place.withColumn("rank", F.row_number().over(kind.orderBy("n_items", "item_pos"))).withColumn("n", F.count("*").over(kind))
    return ranked.select(F.explode("hashes").alias("hash"), "item_id", "item_pos", (F.col("rank") <= F.floor(F.col("n") / 2) + 1).alias("naming"))


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = 5, literals: int = 2, coverage: float = 0.5, consistency: float = 0.8
) -> DataFrame:
    """One row per (doc_id, item_id) that leaks: n_windows, n_matched, coverage, slot_consistency.

    A pair leaks when at least ``coverage`` of the item's windows occur in the document and at
    least ``consistency`` of the item's slot values have one partner only, both at one alignment, in
    a run of alignments less than half an item apart (there each place of the item has the value of
    the alignment that matches most), or over all alignments. The figures are those of the candidate
    that passes with the most windows, then the highest consistency.

    An item of fewer than ``window`` tokens, but ``SHORTEST`` or more, is one window and is found where all
    its values follow each other in a document; with other values it can't be told from chance.
    Rows that repeat a doc_id are one document; null ids, null or empty texts and shorter items have
    no leaks; repeated items count once; texts of any length are read whole; an empty table on
    either side gives an empty result; other columns are ignored.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(leaks(docs, items, window, literals, coverage, consistency), "leaks")


def leaks(docs: DataFrame, items: DataFrame, window: int, literals: int, coverage: float, consistency: float) -> DataFrame:
    items = items.select(F.col("item_id"), F.col("text")).where("item_id is not null").distinct()
    capital = whole_text().rlike(r"^[^\p{L}\p{M}0-9]*\p{Lu}\p{Ll}")
    items = with_tokens(items).where(F.size("canon") >= SHORTEST).select("item_id", "raw", "canon", capital.alias("capital"))
    items = materialize(items, "items")
    lengths = {r[0] for r in items.where(F.size("canon") < window).select(F.size("canon")).distinct().collect()}  # fewer than ``window``
    whole = items.where(F.size("canon") < window).select(F.xxhash64(F.lit("whole"), "raw").alias("hash"), "item_id", F.lit(1).alias("item_pos"), F.lit(True).alias("naming"))
    index = materialize(item_windows(items, window, literals).unionByName(whole), "windows")

    docs = docs.select("doc_id", "text").where("doc_id is not null")

    def places(tokens: Column) -> Column:
        canon, raw = tokens["canon"], tokens["raw"]
        place = lambda p, h: F.struct(p.cast("int").alias("doc_pos"), h.alias("hash"))

        def of(size: int, found: Column) -> Column:
            return F.when(F.size(canon) >= size, found).otherwise(F.expr("cast(array() as array<struct<doc_pos:int,hash:bigint>>)"))

        # The index holds templates with enough plain words only, so any template may be asked for.
        found = [
            of(window, F.transform(template_hashes(canon, window), lambda h, i: place(i + 1, h))),
            of(window, F.transform(wordless(canon, window, literals), lambda p: place(p, values_hash(raw, p, window)))),
        ]

        def whole_items(size: int) -> Column:
            # The size comes from around the lambda: Spark hands a second parameter of its own, the index, even to one with a default.
            starts = F.sequence(F.lit(1), F.size(canon) - size + 1)
            return of(size, F.transform(starts, lambda p: place(p, F.xxhash64(F.lit("whole"), F.slice(raw, p, size)))))

        return F.concat(*found, *(whole_items(size) for size in sorted(lengths)))

    def windows(some: DataFrame) -> DataFrame:
        tokens = F.struct(canon_tokens(whole_text()).alias("canon"), raw_tokens(whole_text()).alias("raw"))
        return some.select("doc_id", F.explode(let(tokens, places)).alias("w")).select("doc_id", "w.*")

    naming = materialize(index.where("naming").select("hash", "item_id").distinct(), "naming")
    named = materialize(windows(docs).join(checked_broadcast(naming), "hash").select("doc_id", "item_id").distinct(), "named")
    # Of a named pair every alignment is wanted, by all of the item's windows; one row per alignment, however many windows agree on it.
    again = windows(docs.join(checked_broadcast(materialize(named.select("doc_id").distinct(), "named-docs")), "doc_id"))
    sought = named.join(checked_broadcast(index), "item_id").select("doc_id", "item_id", "hash", "item_pos")
    hits = again.join(sought, ["doc_id", "hash"]).select("doc_id", "item_id", (F.col("doc_pos") - F.col("item_pos")).alias("shift")).distinct()
    hits = materialize(hits, "hits")
    lens = checked_broadcast(materialize(items.select("item_id", F.size("canon").alias("len")), "lengths"))
    per_doc = materialize(hits.join(lens, "item_id").groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift", "len")).alias("hits")), "aligned")

    aligned = with_tokens(docs.join(checked_broadcast(per_doc), "doc_id"))
    i = items.select("item_id", F.col("raw").alias("item_raw"), F.col("canon").alias("item_canon"))

    def cut(tokens: Column, hit: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), hit["len"]), lambda p: F.get(tokens, hit["shift"] + p - 1))

    # Only the aligned pieces of a document travel on; rows of one doc_id with other texts are told apart.
    pieces = aligned.select(
        "doc_id",
        F.xxhash64("raw").alias("part"),
        F.explode(
            let(
                F.struct("canon", "raw"),
                lambda d: F.transform("hits", lambda h: F.struct(h["item_id"].alias("item_id"), h["shift"].alias("shift"), cut(d["canon"], h).alias("canon"), cut(d["raw"], h).alias("raw"))),
            )
        ).alias("piece"),
    ).select("doc_id", "part", "piece.*")
    # Equal values are the same whatever they were taken for; a short item needs them.
    by_value = F.zip_with("raw", "item_raw", lambda a, b: a.eqNullSafe(b))
    by_type = F.zip_with("canon", "item_canon", lambda a, b: a.eqNullSafe(b))
    same = F.zip_with(by_value, F.when(F.size("item_canon") >= window, by_type).otherwise(by_value), lambda a, b: a | b)
    size = F.least(F.lit(window), F.size("item_canon"))
    matched = F.filter(F.sequence(F.lit(1), F.size("item_canon") - size + 1), lambda p: F.forall(F.slice(F.col("same"), p, size), lambda x: x))
    slots = F.filter(
        F.transform(
            F.sequence(F.lit(1), F.size("item_canon")),
            lambda p: F.struct(F.get("item_canon", p - 1).alias("type"), F.get("item_raw", p - 1).alias("a"), F.get("raw", p - 1).alias("b"), p.alias("p")),
        ),
        lambda s: s["type"].isin(NUMBER, UNIT, NAME) & F.exists(F.col("matched"), lambda m: s["p"].between(m, m + F.least(F.lit(window), F.size("item_canon")) - 1)),
    )
    compared = (
        pieces.join(checked_broadcast(i), "item_id")
        .withColumn("same", same)
        .withColumn("matched", matched)
        .where(F.size("matched") > 0)
        .withColumn("slots", slots)
        .select("doc_id", "item_id", "part", "shift", F.size("item_canon").alias("len"), "matched", "slots")
    )
    near = Window.partitionBy("doc_id", "item_id", "part").orderBy("shift")
    compared = compared.withColumn("apart", F.col("shift") - F.lag("shift").over(near) > F.col("len") / 2)
    compared = materialize(compared.withColumn("run", F.count(F.when(F.col("apart"), 1)).over(near)), "compared")

    def values(slots: Column) -> Column:
        return F.array_distinct(F.transform(slots, lambda s: F.struct(s["type"], s["a"], s["b"])))

    def first_by_place(slots: Column) -> Column:
        places = F.array_distinct(F.transform(slots, lambda s: s["p"]))
        return F.transform(places, lambda p: F.get(F.filter(slots, lambda s: s["p"] == p), F.lit(0)))

    together = F.array_distinct(F.flatten(F.collect_list("matched"))).alias("matched")
    best_first = F.sort_array(F.collect_list(F.struct(F.size("matched").alias("n"), (-F.col("shift")).alias("back"), "slots")), asc=False)
    single = compared.select("doc_id", "item_id", "len", "matched", values(F.col("slots")).alias("slots"))
    runs = compared.groupBy("doc_id", "item_id", "part", "run").agg(F.first("len").alias("len"), together, F.flatten(best_first["slots"]).alias("slots"))
    runs = runs.select("doc_id", "item_id", "len", "matched", values(first_by_place(F.col("slots"))).alias("slots"))
    pooled = compared.groupBy("doc_id", "item_id").agg(F.first("len").alias("len"), together, values(F.flatten(F.collect_list("slots"))).alias("slots"))
    keys = F.array_distinct(F.transform("slots", lambda s: F.struct(s["type"], s["a"])))
    # The slots are distinct, so a key that is there once has one partner.
    alone = F.filter(keys, lambda k: F.size(F.filter("slots", lambda s: F.struct(s["type"], s["a"]) == k)) == 1)
    passed = (
        single.unionByName(runs)
        .unionByName(pooled)
        .withColumn("n_windows", F.greatest(F.col("len") - window + 1, F.lit(1)).cast("long"))
        .withColumn("n_matched", F.size("matched").cast("long"))
        .withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
        .withColumn("slot_consistency", F.when(F.size("slots") == 0, 1.0).otherwise(F.size(alone) / F.size(keys)))
        .where((F.col("coverage") >= coverage) & (F.col("slot_consistency") >= consistency))
    )
    best = passed.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_matched", "slot_consistency", "n_windows", "coverage")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_windows", "best.n_matched", "best.coverage", "best.slot_consistency")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item, as it is or with other values in its slots."""
    return drop_ids(docs, find_leaks(docs, items).select("doc_id"), "leaks")
