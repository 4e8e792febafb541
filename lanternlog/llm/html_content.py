"""Main text of web pages as the maximum-scoring run of page tokens.

A page becomes a sequence of words and tags. Words score positive and tags negative; the weights
are log ratios of how often a token occurs inside and outside the article of pages that mark one
(the labelled pages, menus and other furniture counted as outside), clamped to their sign. Tags
within a marked article hardly count: its author has said that all of it belongs together, and what
stands beside the articles of a page that marks some scores negative. One linear scan finds the contiguous run of the
highest sum. Elements that never hold main text (scripts, menus, forms, adverts, comments and so
on, by name, role or class) are a negative token and their words score negative too; they are never part of the text. Where a script
has no spaces, each letter counts as a word. A class or id
is only a hint: an element around an ``<article>`` or ``<main>``, around most words of a page
without them, or with a hint word only as part of a name (``has-sidebar``), keeps its words and
counts as a negative token of its own. The text is that of the blocks which the run touches.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by role, and class or id words of page furniture.
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br img wbr "
    "math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext "
    "mtr munder munderover semantics".split()
)
OPAQUE = "script|style|noscript|template|textarea|svg|iframe|object|select|title|canvas|audio|video"
FURNITURE = frozenset("nav header footer aside form menu dialog button head datalist map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices popup modal overlay comment comments "
    "disqus discussion respond reply replies related recommended share sharing social newsletter subscribe signup login widget widgets toolbar "
    "pagination pager skip".split()
)
SKIP = "#skip"
HINT = "#hint"
NAMED = "#named"
WORD = "#word"
#: Words of a skipped element: of no page text, but told to whoever learns weights.
LOST = "#lost"
#: A tag or skipped element within a marked article, whose author says that all of it belongs together.
INSIDE_TAG = -0.01
#: Elements that hold a whole page or article: they say nothing about what is in them.
STRUCTURE = frozenset("html body article main".split())
#: Bounds of what is learned: no tag outweighs more than a few words.
WORD_WEIGHTS, TAG_WEIGHTS = (0.05, 1.0), (-3.0, -0.05)
#: Elements of running text. Of the hint words these alone make furniture of them: a line may well be called a banner.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 span b i em strong blockquote pre dt dd figcaption".split())
PLAIN_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr newsletter subscribe share sharing social "
    "related recommended comment comments disqus breadcrumb breadcrumbs".split()
)
#: Used where no page marks its article.
DEFAULT_WEIGHTS = {WORD: 0.7, SKIP: -6.0, HINT: -3.0, "a": -1.5, "li": -1.5, "ul": -2.0, "div": -1.0, "td": -1.0, "tr": -1.0, "table": -2.0}
OTHER_TAG = -0.3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<note>annotation-xml|annotation)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=note)\s*>|\Z)"
    rf"|<(?P<opaque>{OPAQUE})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=opaque)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
MAIN = ("article", "main")
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p a span li dt dd td th figure".split())
#: Letters of scripts written without spaces: Thai, Lao, Tibetan, Burmese, Khmer, kana, bopomofo, Chinese characters and Yi.
SPACELESS = re.compile(
    r"(?=\w)[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u303c\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff"
    r"\u3400-\u4dbf\u4e00-\ua4cf\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]"
)


def n_words(text: str) -> int:
    """Words between spaces; each letter of a script without spaces is one, marks between such letters are none."""
    if text.isascii() or not SPACELESS.search(text):
        return len(text.split())
    rest, letters = SPACELESS.subn(" ", text)
    return letters + sum(any(map(str.isalnum, w)) for w in rest.split())


def hint_of(attrs: str, name: str = "div") -> str | None:
    """NAMED if a class or the id consists of hint words, HINT if one only holds such a word, SKIP if role or visibility say so.

    The id of a heading or a piece of text is an anchor made of its words, and tells nothing.
    """
    found, hints = None, PLAIN_HINTS if name in TEXT else HINTS
    for key, value in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return SKIP
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return SKIP
        if key == "class" or key == "id" and name not in ANCHORED:
            for words in (set(re.findall("[a-z0-9]+", x)) for x in value.split()):
                if words and words <= hints:
                    found = NAMED
                elif not hints.isdisjoint(words):
                    found = found or HINT
    return found


def role_of(name: str, attrs: str, in_article: bool) -> str | None:
    if name in FURNITURE and not (name == "header" and in_article):
        return SKIP
    return hint_of(attrs, name) if attrs and name not in ("html", "body", *MAIN) else None


def spared(page: str) -> set[int]:
    """Starts of the NAMED elements around an article or main element, or with most words of the articles (else main, else page)."""
    stack: list[str] = []
    starts: list[int] = []
    marked: set[int] = set()
    held, total = {}, [0, 0, 0]
    for kind, text, inside in walk(page, None, stack, starts, marked):
        if kind == WORD:
            n, depth = n_words(text), 2 if inside else int("main" in stack)
            for level in range(depth + 1):
                total[level] += n
                for at in starts:
                    if at >= 0:
                        held[at, level] = held.get((at, level), 0) + n
    most = max(level for level in range(3) if total[level] or not level)
    return marked | {at for (at, level), n in held.items() if level == most and 2 * n > total[level]}


def tokens(page: str, lost: bool = False) -> Iterator[tuple[str, str | None, bool]]:
    """(kind, text, inside the marked article): kind is ``#word`` for a piece of text, ``#skip``, ``#hint`` or a tag name, with ``lost`` also ``#lost``."""
    return walk(page, spared(page), [], [], set(), lost)


def walk(page: str, spare: set[int] | None, stack: list[str], starts: list[int], marked: set[int], lost: bool = False) -> Iterator[tuple[str, str | None, bool]]:
    """As ``tokens``; NAMED elements that start elsewhere than in ``spare`` are skipped, none where it is None.

    ``stack`` and ``starts`` hold the open elements and the starts of the NAMED ones (else -1);
    ``marked`` gets the starts of those around an article or main element without a hint of its own.
    """
    skipping = article = 0
    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            if not skipping:
                yield WORD, html.unescape(m["text"]), article > 0
            elif lost:
                yield LOST, html.unescape(m["text"]), article > 0
            continue
        if m["opaque"]:
            if not skipping:
                yield SKIP, None, article > 0
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            if name not in stack:
                continue
            at = len(stack) - 1 - stack[::-1].index(name)
            # An inline end tag doesn't close a block around it.
            if name in INLINE and any(x in BLOCKS or x in FURNITURE for x in stack[at + 1 :]):
                del stack[at], starts[at]
                if skipping > at:
                    skipping -= 1
                continue
            article -= stack[at:].count("article")
            del stack[at:], starts[at:]
            if skipping > at:
                skipping = 0
                continue
            if not skipping:
                yield name, None, article > 0
            continue
        start = -1
        if not skipping:
            role = None if name in VOID else role_of(name, m["attrs"], article > 0)
            if role == NAMED:
                start = m.start()
                role = HINT if spare is None or start in spare else SKIP
            if role == SKIP:
                skipping = len(stack) + 1
                yield SKIP, None, article > 0
            else:
                if role == HINT:
                    yield HINT, None, article > 0
                yield name, None, article > 0
                if name in MAIN and not hint_of(m["attrs"]):
                    marked.update(x for x in starts if x >= 0)
        if name not in VOID and not m["attrs"].rstrip().endswith("/"):
            stack.append(name)
            starts.append(start)
            article += name == "article"


def blocks_and_scores(page: str, weights: dict[str, float]) -> tuple[list[list[str]], list[tuple[int, float]]]:
    """Texts of the blocks, and (block or -1, score) of each token in page order.

    Words of skipped elements score negative, and words beside the articles of a page that marks some as far below
    zero as the others above.
    """
    blocks: list[list[str]] = [[]]
    found = list(tokens(page, lost=True))
    marked = any(inside for _, _, inside in found)
    scores = []
    for kind, text, inside in found:
        if kind == WORD:
            blocks[-1].append(text)
            if n := n_words(text):
                scores.append((len(blocks) - 1, n * weights[WORD] * (1 if inside or not marked else -1)))
            continue
        if kind == LOST:
            scores.append((-1, INSIDE_TAG if inside else n_words(text) * weights.get(LOST, -weights[WORD])))
            continue
        scores.append((-1, INSIDE_TAG if inside else TAG_WEIGHTS[1] if kind in STRUCTURE else weights.get(kind, OTHER_TAG)))
        if kind == "br":
            blocks[-1].append(" ")
        elif kind != HINT and kind not in INLINE:
            if blocks[-1]:
                blocks.append([])
    return blocks, scores


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks that the run of the highest sum touches, of equal ones the first, without those that score below zero."""
    blocks, scores = blocks_and_scores(page or "", weights)
    best, run, start, span = 0.0, 0.0, 0, None
    for i, (_, score) in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, span = run, (start, i)
    if span is None:
        return ""
    touched = [(b, score) for b, score in scores[span[0] : span[1] + 1] if b >= 0]
    beside = {b for b, score in touched if score < 0}
    texts = (" ".join("".join(blocks[b]).split()) for b in range(touched[0][0], touched[-1][0] + 1) if b not in beside)
    return "\n\n".join(t for t in texts if t)


def learned_weights(pages: DataFrame) -> dict[str, float]:
    """Weights from all pages that mark exactly one article; the defaults where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        known = BLOCKS | INLINE | VOID | {SKIP, HINT, WORD}
        for b in batches:
            for page in b.column(0).to_pylist():
                if page and len(re.findall(r"<article\b", page, re.I)) == 1:
                    for kind, text, inside in tokens(page, lost=True):
                        if kind == LOST:
                            counts[LOST, False] += n_words(text)  # also within the article: they are none of its text
                        elif kind not in STRUCTURE:
                            counts[kind if kind in known else "#other", inside] += n_words(text) if kind == WORD else 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()), pa.array([counts[k] for k in keys], pa.int64())], ["kind", "inside", "n"]
        )

    rows = pages.select(F.col("html").cast("string")).mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    n = {(r["kind"], r["inside"]): r["n"] for r in rows}  # at most two rows per known element
    total = {side: sum(v for (_, i), v in n.items() if i == side) for side in (True, False)}
    if not total[True] or not total[False]:
        return DEFAULT_WEIGHTS
    kinds = {k for k, _ in n}
    out = {}
    for k in kinds:
        ratio = math.log((n.get((k, True), 0) + 1) / (total[True] + len(kinds))) - math.log((n.get((k, False), 0) + 1) / (total[False] + len(kinds)))
        least, most = {WORD: WORD_WEIGHTS, LOST: (-WORD_WEIGHTS[1], -WORD_WEIGHTS[0])}.get(k, TAG_WEIGHTS)
        out[k] = min(max(ratio, least), most)
    return out


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``.

    A null or empty page gives an empty text. Broken markup is read as far as it goes: an
    unclosed comment or script ends with the page, an end tag without a start is ignored. Pages of
    any length are read whole, rows that repeat give a row each, an empty table gives an empty
    result, of runs that tie the first counts; other columns are ignored.
    """
    weights = weights or learned_weights(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(page, weights) for page in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    columns = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")
