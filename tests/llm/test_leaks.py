"""Leaks against the rule in plain Python, on benchmarks without short items: words put in, left out, halves, other values, several alignments."""

import random
from collections import defaultdict

from lanternlog.llm import decontaminate
from lanternlog.llm.decontaminate import NAME, NUMBER, UNIT

WINDOW, LITERALS, COVERAGE, CONSISTENCY = 5, 2, 0.5, 0.8
SLOTS = (NUMBER, UNIT, NAME)
WORDS = [a + b + c for a in ("ka", "lo", "mi", "ru", "se") for b in ("na", "to", "ve", "ri") for c in ("", "s", "n")]
NAMES = ["Lisbon", "Oslo", "Maria", "Peter", "Quito", "Dakar"]


def keys_of(canon, raw):
    """Key of the window at each place."""
    out = []
    for p in range(len(canon) - WINDOW + 1):
        c = canon[p : p + WINDOW]
        worded = sum(t not in SLOTS for t in c) >= LITERALS
        out.append((worded, ("template", *c) if worded else ("values", *raw[p : p + WINDOW])))
    return out


def plain_leaks(docs, items):
    """doc_id, item_id -> (n_matched, slot_consistency), from the tokens alone; items are (id, canon, raw, capital)."""
    forms = {}  # item -> place -> [(worded, key)]
    for item_id, canon, raw, capital in items:
        places = [[k] for k in keys_of(canon, raw)]
        if capital:
            places[0] += keys_of([NAME, *canon[1:WINDOW]], raw[:WINDOW])
        forms[item_id] = places
    holders = defaultdict(set)
    for item_id, places in forms.items():
        for place in places:
            for _, k in place:
                holders[k].add(item_id)
    naming = {}
    for item_id, places in forms.items():
        chosen = set()
        for kind in (True, False):
            ranked = sorted((min(len(holders[k]) for _, k in place), p) for p, place in enumerate(places) if any(w for w, _ in place) == kind)
            chosen |= {k for _, p in ranked[: len(ranked) // 2 + 1] for _, k in places[p]}
        naming[item_id] = chosen
    out, certain = {}, set()
    for doc_id, d_canon, d_raw in docs:
        at = defaultdict(list)
        for p, (_, k) in enumerate(keys_of(d_canon, d_raw)):
            at[k].append(p)
        for item_id, canon, raw, _ in items:
            places, n = forms[item_id], len(canon)
            shifts = sorted({q - p for p, place in enumerate(places) for _, k in place for q in at.get(k, ())})
            if not shifts:
                continue
            seen = []
            for s in shifts:
                get = lambda tokens, p, s=s: tokens[p + s] if 0 <= p + s < len(tokens) else None
                same = [get(d_raw, p) == raw[p] or get(d_canon, p) == canon[p] for p in range(n)]
                matched = {p for p in range(n - WINDOW + 1) if all(same[p : p + WINDOW])}
                slots = [(canon[p], raw[p], get(d_raw, p), p) for p in range(n) if canon[p] in SLOTS and any(m <= p < m + WINDOW for m in matched)]
                if matched:
                    seen.append((s, matched, slots))
            runs = []
            for s, matched, slots in seen:
                if not runs or s - runs[-1][-1][0] > n / 2:
                    runs.append([])
                runs[-1].append((s, matched, slots))
            candidates = [(m, {x[:3] for x in sl}) for _, m, sl in seen]
            for run in runs:
                first = {}
                for _, _, sl in sorted(run, key=lambda r: (-len(r[1]), r[0])):
                    for x in sl:
                        first.setdefault(x[3], x[:3])
                candidates.append((set().union(*(m for _, m, _ in run)), set(first.values())))
            candidates.append((set().union(*(m for _, m, _ in seen)), {x[:3] for _, _, sl in seen for x in sl}))
            passed = []
            for matched, values in candidates:
                partners = defaultdict(set)
                for kind, a, b in values:
                    partners[kind, a].add(b)
                share = sum(len(b) == 1 for b in partners.values()) / len(partners) if partners else 1.0
                if len(matched) / (n - WINDOW + 1) >= COVERAGE and share >= CONSISTENCY:
                    passed.append((len(matched), share))
            if not passed:
                continue
            if any(k in at for k in naming[item_id]):
                out[doc_id, item_id] = max(passed)
            found = {kind: [any(k in at for _, k in place) for place in places if any(w for w, _ in place) == kind] for kind in (True, False)}
            if any(x and 2 * sum(x) >= len(x) for x in found.values()):
                certain.add((doc_id, item_id))
    return out, certain


def item(rng, n):
    shared = ["question", "choose", "the", "right", "answer"] if rng.random() < 0.4 and n > 12 else []
    words = shared + [rng.choice(WORDS) for _ in range(n - len(shared))]
    for i in range(len(shared), n):
        if (x := rng.random()) < 0.12:
            words[i] = str(rng.randint(1, 40))
        elif x < 0.2 and i:
            words[i] = rng.choice(NAMES)
    return [words[0].capitalize(), *words[1:]] if rng.random() < 0.5 else words


def altered(rng, words):
    """A copy as leaks have it, or a broken one."""
    kind, n = rng.randrange(9), len(words)
    if kind == 1:  # words put in
        for _ in range(rng.randint(1, 2)):
            at = rng.randint(1, n - 1)
            words = words[:at] + [rng.choice(WORDS)] * rng.randint(1, 3) + words[at:]
    elif kind == 2:  # left out
        at = rng.randint(1, n - 2)
        words = words[:at] + words[at + rng.randint(1, 2) :]
    elif kind == 3:
        words = words[: rng.randint(n // 2, n)]
    elif kind == 4:
        words = words[n - rng.randint(n // 2, n) :]
    elif kind in (5, 6):  # other values, the same everywhere or (6) here and there
        to = {w: str(rng.randint(50, 90)) for w in words if w.isdigit()} | {w: rng.choice(["Cairo", "Lima"]) for w in words if w in NAMES}
        words = [to.get(w, w) if kind == 5 or rng.random() < 0.5 else w for w in words]
    elif kind == 7:  # twice, the second time with another value
        words = [*words, *(rng.choice(WORDS) for _ in range(rng.randint(0, 30))), *(str(int(w) + 1) if w.isdigit() else w for w in words)]
    elif kind == 8:
        rng.shuffle(words)
    return words


def test_leaks_are_the_rules(spark):
    rng = random.Random(12)
    items = [item(rng, rng.choice([5, 6, 8, 12, 20, 35, 60])) for _ in range(70)]
    rows = []
    for i in range(420):
        head, tail = ([rng.choice(WORDS) for _ in range(rng.randint(0, 40))] for _ in range(2))
        chosen = [altered(rng, list(rng.choice(items))) for _ in range(rng.choice([0, 1, 1, 1, 2]))]
        rows.append((i, " ".join([*head, *(w for c in chosen for w in c), *tail])))
    rows.append((999, " ".join([*(rng.choice(WORDS) for _ in range(30_000)), *items[3]])))
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    tokens = [(r["doc_id"], r["canon"], r["raw"]) for r in decontaminate.with_tokens(docs).collect()]
    wanted = [(r["item_id"], r["canon"], r["raw"], r["text"][0].isupper()) for r in decontaminate.with_tokens(benchmark).collect()]
    want, certain = plain_leaks(tokens, wanted)
    got = {(r["doc_id"], r["item_id"]): (r["n_matched"], r["slot_consistency"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert got == want, (sorted(set(got) ^ set(want))[:8], [(k, got[k], want[k]) for k in got.keys() & want.keys() if got[k] != want[k]][:5])
    # Nothing that holds half of an item's windows is lost by naming pairs first.
    assert certain <= set(got) and len(certain) > 250 and (999, 3) in got


def test_parts_and_insertions_are_found(spark):
    rng = random.Random(5)
    words = [w for w in WORDS if len(w) > 4]
    alone, short, seven = ([rng.choice(words) for _ in range(n)] for n in (20, 5, 7))
    rows, want = [], set()
    for offset in range(10):
        head = [rng.choice(["zu", "pe", "fo"]) for _ in range(offset)]
        for part in ([*alone[:10], "zzz", *alone[10:]], alone[-12:], alone[-13:], alone[:12], [*alone[:9], *alone[10:]]):
            want.add(len(rows))
            rows.append((len(rows), " ".join([*head, *part, "end"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for others in ((), (short,), (seven,)):
        items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((alone, *others))], "item_id long, text string")
        assert {r["doc_id"] for r in decontaminate.find_leaks(docs, items).collect() if r["item_id"] == 0} == want


def test_short_items_of_both_sizes_are_found_at_every_place(spark):
    texts = {0: "Is 7 prime?", 1: "Name two rivers here", 2: "Is 8 odd?"}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    rows, want = [], set()
    for offset in range(12):
        head = " ".join(WORDS[:offset])
        for item in (0, 1):
            rows.append((len(rows), f"{head} {texts[item]} {WORDS[-1]}"))
            want.add((rows[-1][0], item))
        rows.append((len(rows), f"{head} is 9 prime? name three rivers here"))
    rows.append((len(rows), "Is 7"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()} == want
