"""Personal data spans in DataFrame functions only: patterns propose, checksums confirm, context scores.

Positions come from cutting a text by a pattern: the lengths of the parts before and of the
matches before a match add up to its start, in code points. The patterns are written so that the
regex engine neither recurses nor restarts inside a run it has already rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text

# Characters of an IBAN by country, from the ISO 13616 registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC",
    32: "LC", 33: "RU",
}
IBAN_COUNTRIES = "^(?:" + "|".join(IBAN_LENGTHS.values()) + ")"
# A country's IBAN has its length, so the words behind it stay out; of another country's, see ``iban_piece``.
IBAN_REST = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, c in IBAN_LENGTHS.items())

# Kinds in report order, their patterns and the words that make a span likelier.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone", "secret")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN_REST}|(?!{IBAN_COUNTRIES[1:]})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+)\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    # Keys that tell by their own form, and values behind the name of a secret.
    "secret": (
        r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}+|sk-[A-Za-z0-9_-]{16,}+|sk_live_[A-Za-z0-9]{16,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{30,}+|"
        r"eyJ[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]*+|-----BEGIN\x20[A-Z\x20]{0,20}PRIVATE\x20KEY-----)"
        r"|(?i:(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key|auth[_-]?token)[\x20\t]{0,3}+[:=][\x20\t]{0,3}+[\"']?[^\s\"',;]{6,}+)"
    ),
}
#: A text without this can't match the kind: a cheap test before the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
CONTEXT = {
    "email": r"mail|contact|write|schreib|correo|courriel",
    "ip": r"\bip\b|address|server|host|login",
    "card": r"card|visa|master|amex|credit|karte|carte|tarjeta",
    "phone": r"phone|call|tel|mobile|fax|anruf|llam|appel",
    "iban": r"iban|bank|account|konto|compte|cuenta",
    "ssn": r"ssn|social|security|insurance",
    "local_phone": r"phone|call|tel|mobile|fax|anruf|llam|appel",
    "secret": r"key|secret|token|password|credential",
}
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.9, "ssn": 0.35, "local_phone": 0.4, "secret": 0.8}
BASE = KINDS[:4]


def raw_spans(text: Column, kind: str, window: int) -> Column:
    """Leftmost non-overlapping matches as (start, end, match, before, after), starts in code points from 0."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,match:string,before:string,after:string>>)")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.char_length(pair["0"])
        end = start + F.char_length(pair["1"])
        # Context may reach over other matches of the kind, so it is cut from the text.
        before = F.substring(text, F.greatest(start - window, F.lit(0)) + 1, F.least(start, F.lit(window)))
        span = F.struct(start.alias("start"), end.alias("end"), pair["1"].alias("match"), before.alias("before"), F.substring(text, end + 1, F.lit(window)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.filter(F.arrays_zip(between, found), lambda p: p["1"].isNotNull())
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])
    needed = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(PATTERNS[kind])
    return F.when(needed, spans).otherwise(empty)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Sum over the digits from the right, every second doubled and reduced by 9 above 9, divides by 10."""
    each = F.split(F.reverse(digits), "")
    doubled = F.transform(each, lambda d, i: (F.try_to_number(d, F.lit("9")).cast("int") * (1 + i % 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def mod97(match: Column) -> Column:
    """First four characters moved behind, letters as 10 to 35, remainder by 97 is 1."""
    flat = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4))
    codes = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(codes, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.char_length(digits_of(match)).between(14, 19) & luhn(digits_of(match))
    if kind == "phone":
        return F.char_length(digits_of(match)).between(10, 15)
    if kind == "iban":
        return F.char_length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def iban_piece(s: Column) -> Column:
    """The longest piece up to a space that passes, where the country's length isn't known: the pattern also takes words behind."""
    words = F.split(s["match"], " ")
    heads = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    piece = F.coalesce(F.get(F.filter(heads, lambda h: confirmed("iban", h)), F.lit(0)), s["match"])
    short = F.struct(s["start"].alias("start"), (s["start"] + F.char_length(piece)).alias("end"), piece.alias("match"), s["before"].alias("before"), s["after"].alias("after"))
    return F.when(s["match"].rlike(IBAN_COUNTRIES), s).otherwise(short)


def kind_spans(text: Column, kind: str, order: int, threshold: float, window: int) -> Column:
    """Confirmed spans of one kind with their scores, those below ``threshold`` left out."""
    def scored(s: Column) -> Column:
        near = F.when(F.lower(F.concat(s["before"], F.lit(" "), s["after"])).rlike(CONTEXT[kind]), 0.3).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["match"].alias("match"),
            F.least(F.lit(1.0), F.lit(PRIOR[kind]) + near).alias("score"),
        )

    raw = raw_spans(text, kind, window)
    good = F.filter(F.transform(raw, iban_piece) if kind == "iban" else raw, lambda s: confirmed(kind, s["match"]))
    return F.filter(F.transform(good, scored), lambda s: s["score"] >= threshold)


def find_spans(docs: DataFrame, text: str = "text", threshold: float = 0.5, window: int = 40) -> DataFrame:
    """Adds ``pii``: spans (start, end, kind, match, score) of the whole text, by start, then kind as listed.

    The four checked kinds and secrets are reported whenever their check passes; context only raises
    their score. Kinds without a strong check need a context word within ``window`` characters before
    or behind to reach ``threshold``. A null or empty text has no spans, a text of any length is read
    whole, rows that repeat get theirs each, an empty table gives an empty result; other columns stay,
    but for one named ``pii``, which is replaced.
    """
    t = whole_text(text)
    spans = let(t, lambda x: F.array_sort(F.concat(*[kind_spans(x, kind, order, threshold, window) for order, kind in enumerate(KINDS)])))
    return docs.withColumn("pii", spans)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by ``[KIND]``; of overlapping spans the earlier start wins."""
    found = find_spans(docs, text)
    done = F.aggregate(
        "pii",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(whole_text(text), a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        ),
        lambda a: F.concat(a["out"], F.substring(whole_text(text), a["at"] + 1, F.char_length(whole_text(text)))),
    )
    return found.withColumn(text, F.when(F.col(text).isNotNull(), done)).drop("pii")


def span_digest(docs: DataFrame) -> DataFrame:
    """Per document the counts of the four base kinds and the joined span lists."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = find_spans(docs.select("doc_id", "text"))
    def counted(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[counted(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))
