"""Masking of secrets by field name and by pattern."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MASK = "[REDACTED]"

# Sensitive field names, their single-word and compound markers, and secret keys in text.
DEFAULT_FIELDS = (
    "password", "passwd", "pwd", "secret", "token", "access_token", "refresh_token", "session_token", "api_key", "apikey",
    "authorization", "credentials", "private_key", "client_secret",
)
WORD_MARKERS = ("password", "passwd", "pwd", "passphrase", "secret", "token", "authorization", "auth", "credential", "credentials")
COMPOUND_MARKERS = (
    "apikey", "apisecret", "accesskey", "secretkey", "privatekey", "accesstoken", "refreshtoken", "sessiontoken", "bearertoken", "clientsecret",
)
SECRET_KEYS = (
    "access[_-]?token|refresh[_-]?token|session[_-]?token|bearer[_-]?token|client[_-]?secret|api[_-]?secret|secret[_-]?key|private[_-]?key|"
    "auth[_-]?token|api[_-]?key|apikey|passphrase|credentials|credential|password|passwd|pwd|secret|session|cookie|token|jwt"
)
# Fixed values: (pattern, replacement, ignore case) in the order they apply.
TEXT_RULES = (
    (r"\bbearer\s+[A-Za-z0-9._~+/=-]+", "Bearer [REDACTED]", True),
    (r"\bauthorization\s*[:=]\s*\S+(?:\s+[A-Za-z0-9._~+/=-]+)?", "Authorization: [REDACTED]", True),
    (rf"\b({SECRET_KEYS})\s*[:=]\s*(?:\"[^\"]*\"|'[^']*'|[^'\"\s,;}}]+)", "$1=[REDACTED]", True),
    (r"\b([a-zA-Z][a-zA-Z0-9+.-]*://[^\s:/@]*):[^\s/?#@]+@", "$1:[REDACTED]@", False),
    (r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*", "[REDACTED]", False),
)
EMAIL_RULE = (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[REDACTED]", False)


@dataclass(frozen=True)
class RedactionSpec:
    """What to mask. ``patterns``: (pattern, replacement) pairs in Python's syntax, applied last."""

    fields: tuple[str, ...] = ()
    replace_default_fields: bool = False
    emails: bool = False
    patterns: tuple[tuple[str, str], ...] = ()
    max_chars: int = 8000
    max_depth: int = 48
    max_nodes: int = 50_000
    names: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        for pattern, _ in self.patterns:
            re.compile(pattern)
        kept = () if self.replace_default_fields else DEFAULT_FIELDS
        object.__setattr__(self, "names", frozenset(name.lower() for name in (*kept, *self.fields)))

    def rules(self) -> tuple[tuple[str, str, bool], ...]:
        own = tuple((p, python_replacement(r), False) for p, r in self.patterns)
        return (*TEXT_RULES, *((EMAIL_RULE,) if self.emails else ()), *own)


def python_replacement(replacement: str) -> str:
    """A replacement in Java's syntax: ``\\1`` and ``\\g<n>`` become ``$1`` and ``${n}``, a plain ``$`` is escaped."""
    out = replacement.replace("$", r"\$")
    out = re.sub(r"\\g<(\w+)>", lambda m: "$" + m[1] if m[1].isdigit() else "${" + m[1] + "}", out)
    return re.sub(r"\\(\d)", r"$\1", out)


def java_pattern(pattern: str, ignore_case: bool) -> str:
    return ("(?iuU)" if ignore_case else "(?U)") + re.sub(r"\(\?P<", "(?<", re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern))


def name_test(spec: RedactionSpec) -> tuple[str, str]:
    """Two patterns, in a syntax that Python and Java share, for a field name in lower case with ``_`` for its word bounds.

    The first finds a listed name or a marker among the words, the second a compound once all bounds are gone.
    """
    return rf"(?:^|_)(?:{'|'.join(WORD_MARKERS)})(?:_|$)", "|".join(COMPOUND_MARKERS)


def is_sensitive(name: str, spec: RedactionSpec) -> bool:
    """Whether a field's name alone tells that its value is secret."""
    word, compound = name_test(spec)
    words = re.sub("[^a-z0-9]+", "_", re.sub("(?<=[a-z0-9])(?=[A-Z])", "_", name).lower())
    return bool(name.lower() in spec.names or re.search(word, words) or re.search(compound, words.replace("_", "")))


def sensitive_name(name: Column, spec: RedactionSpec) -> Column:
    """Column form of ``is_sensitive``."""
    word, compound = name_test(spec)
    words = F.regexp_replace(F.lower(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", "_")), "[^a-z0-9]+", "_")
    listed = F.lower(name).isin(*sorted(spec.names)) if spec.names else F.lit(False)
    return listed | words.rlike(word) | F.replace(words, F.lit("_"), F.lit("")).rlike(compound)


#: No rule but a user's own can match a text without one of these.
CUE = r"(?U)[:=@\s]|eyJ"


#: What Java takes in another sense than Python: end of text, sets inside sets.
OTHER_SENSE = r"\\Z|&&|\[[^\]]*\["


@cache
def java_takes(pattern: str) -> bool:
    """Whether Java compiles the pattern, and in Python's sense; asked of the session's JVM, before any job runs."""
    if re.search(OTHER_SENSE, pattern):
        return False
    try:
        SparkSession.active()._jvm.java.util.regex.Pattern.compile(own_java_pattern(pattern))
    except (Py4JJavaError, IllegalArgumentException):  # PySpark turns the one into the other
        return False
    return True


def own_java_pattern(pattern: str) -> str:
    """A user's pattern for Java, where only ``\\n`` ends a line, as in Python."""
    return "(?d)" + java_pattern(pattern, False)


def redact_own(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The user's rules in their order; from the first that Java doesn't take on they run in Python, a batch at a time."""
    for n, (pattern, replacement) in enumerate(rules):
        if not java_takes(pattern):
            return redact_in_python(text, rules[n:])
        text = F.regexp_replace(text, own_java_pattern(pattern), python_replacement(replacement))
    return text


def redact_in_python(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compiled = [(re.compile(p), r) for p, r in rules]

        def one(item: str | None) -> str | None:
            for pattern, replacement in compiled if item is not None else ():
                item = pattern.sub(replacement, item)
            return item

        for batch in batches:
            yield batch.map(one)

    return run(text)


def redact_text(text: Column, spec: RedactionSpec) -> Column:
    """Cuts a long text with a note of how much, then applies the rules in order; most short values need one look only."""
    cut = F.concat(F.substring(text, 1, spec.max_chars), F.lit("... [truncated "), F.length(text) - spec.max_chars, F.lit(" chars]"))
    short = F.when(F.length(text) > spec.max_chars, cut).otherwise(text)
    out = short
    rules = spec.rules()
    for pattern, replacement, ignore_case in rules[: len(rules) - len(spec.patterns)]:
        out = F.regexp_replace(out, java_pattern(pattern, ignore_case), replacement)
    return redact_own(F.when(short.rlike(CUE), out).otherwise(short), spec.patterns)


def put_in(spec: RedactionSpec) -> list[str]:
    """What masking writes that the text didn't hold, in lower case; ``#`` stands for a digit of the cut note's number."""
    fixed = [re.sub(r"\$\d", "", r) for _, r, _ in (*TEXT_RULES, EMAIL_RULE)]
    notes = [f"... [truncated {'#' * n} chars]" for n in range(1, 11)]
    return [x.lower() for x in (MASK, "[TRUNCATED]", *fixed, *notes)]


def overlaps(needle: str, written: str) -> bool:
    """Whether ``needle`` could be found at a place that takes in some of ``written``: one inside the other, or end to beginning."""
    agree = lambda a, b: a == b or b == "#" and a.isdigit()
    return any(
        all(agree(needle[i], written[i + at]) for i in range(max(0, -at), min(len(needle), len(written) - at))) for at in range(1 - len(needle), len(written))
    )


def raw_holds(text: str, spec: RedactionSpec) -> bool:
    """Whether a match of ``text`` in a masked value can only come from the value itself.

    So it is when the text shares no place with anything that masking writes. A rule replaces what it
    matched by such a piece (but for a group that it puts back), so a match that avoids the pieces lies
    in what was there before. Patterns of the user may write anything. A sigma's small form depends on
    its neighbours, so such a text has no sure small form.
    """
    needle = text.lower()
    return bool(needle) and not spec.patterns and not set("\u03c3\u03c2\u03a3") & set(needle) and not any(overlaps(needle, w) for w in put_in(spec))


def mask_tree(root: object, spec: RedactionSpec, clean: Callable[[str], str]) -> object:
    """A decoded JSON value with secrets masked in place, by an explicit stack of places still to be looked at.

    Places come off in document order. A place too deep, or beyond the allowed number of places, is cut.
    """
    top = [root]
    todo, looked_at = [(top, 0, 0)], 0
    while todo:
        holder, key, depth = todo.pop()
        looked_at += 1
        item, names = holder[key], isinstance(holder, dict)
        if depth > spec.max_depth or looked_at > spec.max_nodes:
            holder[key] = "[TRUNCATED]"
        elif names and key and is_sensitive(key, spec):
            holder[key] = MASK
        elif isinstance(item, str):
            holder[key] = clean(item)
        elif isinstance(item, (dict, list)):
            keys = list(item) if isinstance(item, dict) else range(len(item))
            todo.extend((item, k, depth + 1) for k in reversed(keys))
    return top[0]


def text_cleaner(spec: RedactionSpec) -> Callable[[str], str]:
    """``redact_text`` for one Python string."""
    fixed = [(re.compile(p, re.IGNORECASE if i else 0), re.sub(r"\$(\d)", r"\\\1", r)) for p, r, i in (*TEXT_RULES, *((EMAIL_RULE,) if spec.emails else ()))]
    rules = fixed + [(re.compile(p), r) for p, r in spec.patterns]

    def clean(text: str) -> str:
        over = len(text) - spec.max_chars
        shown = text if over <= 0 else text[: spec.max_chars] + f"... [truncated {over} chars]"
        for pattern, replacement in rules:
            shown = pattern.sub(replacement, shown)
        return shown

    return clean


def redact_json(text: Column, spec: RedactionSpec) -> Column:
    """A JSON object's text with every nested secret masked; what can't be decoded is masked whole."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        clean = text_cleaner(spec)

        def one(item: str | None) -> str | None:
            if item is None:
                return None
            try:
                return json.dumps(mask_tree(json.loads(item), spec, clean), separators=(",", ":"), ensure_ascii=False)
            except (ValueError, RecursionError):
                return json.dumps("[TRUNCATED]")

        for batch in batches:
            yield batch.map(one)

    return run(text)


def redact_attributes(text: Column, spec: RedactionSpec) -> Column:
    """Attributes by built-in functions where every value is a scalar; objects with nested ones go to the helper.

    What a value is comes from the parsed JSON, never from the look of the text. A value that is no
    scalar has no way through the built-in path: it would be masked there.
    """
    if not all(java_takes(p) for p, _ in spec.patterns):
        return redact_json(text, spec)  # a Python function can't run inside the lambdas below
    fragments = F.from_json(text, "map<string,string>")
    parsed = F.try_parse_json(text).try_cast("map<string,variant>")
    nested = parsed.isNull() | F.exists(F.map_values(parsed), lambda v: F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.lit(False)))

    def shown(key: Column, value: Column) -> Column:
        kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
        in_quotes = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
        return (
            F.when(sensitive_name(key, spec), in_quotes(F.lit(MASK)))
            .when(kind == "STRING", in_quotes(redact_text(F.variant_get(value, "$", "string"), spec)))
            .when(kind == "VOID", F.lit("null"))
            .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|BOOLEAN)"), F.coalesce(F.element_at(fragments, key), in_quotes(F.lit(MASK))))
            .otherwise(in_quotes(F.lit(MASK)))
        )

    parts = F.transform(F.map_entries(parsed), lambda e: F.concat(F.regexp_replace(F.to_json(F.array(e["key"])), r"^\[|\]$", ""), F.lit(":"), shown(e["key"], e["value"])))
    flat = F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
    return F.when(text.isNull(), None).when(~nested, flat).otherwise(redact_json(F.when(nested, text), spec))
