"""Main text of web pages by the maximum-scoring subsequence of tokens.

A page is read as a sequence of words and tags. Tags score negative, each kind
by how often it stands outside of the article in labelled pages (those that mark
their article by exactly one ``article`` or ``main`` element). Words score
positive, less by how surely one of their containers is of other matter
(navigation, notices, adverts, forms): a container's kind of tag, role and class
words have a share of other matter learned from the labelled pages, on top of
two pages' worth of a fixed guess. What holds an ``article`` or ``main`` is
never of other matter, nor by its class is what holds nearly all words of a page
without these. One linear scan finds the contiguous run of greatest score, taken
to the bounds of the articles that it starts and ends in: the content region.
Its text, without the words of negative score, is the main text: character references are decoded, inline tags leave no gap,
block tags part blocks, white space in a block becomes one space, and blocks
are joined by one space.

Scripts, styles and comments have no tokens, nor has what is between the tags of
a title, frame, drawing, choice, template or the like; such an element that closes
itself (``<svg/>``), or that is never closed, is empty. A null or empty page, or
one without a word, has an empty text. Unclosed elements end with their parent,
an unclosed script with the page;
a markup sign that opens no tag is text. Repeated rows give equal results.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.common import lean, prepare

#: Pages that the tag weights are learned from, and kinds of tags that are weighted.
SAMPLE_PAGES = 2000
MAX_KINDS = 400
#: Score of a tag that always stands outside of articles; of one never seen.
OUTSIDE, UNSEEN = -2.0, -1.0
#: Score of a word, in content and in a container that is surely of other matter.
WORD_IN, WORD_OUT = 1.0, -0.5
#: Labelled elements that the guess about a container counts as; class words learned.
GUESS, MAX_CONTAINERS = 2, 2000
#: Part of a page's words in one container that its class can't make other matter.
NEARLY_ALL = 0.75

# Elements by what they are (fixed values).
_RAW = "script|style|textarea"
_SKIPPED = "noscript|template|svg|math|iframe|object|title|select"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
_OTHER = frozenset("nav footer aside form button menu dialog label fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adbox|banner|sponsor(?:ed)?|promo(?:tion)?|nav(?:bar|igation)?"
    r"|menu|sidebar|breadcrumbs?|cookies?|consent|gdpr|notice|newsletter|subscribe|share|sharing|social|comments?"
    r"|replies|disqus|related|recommended|footer|masthead|popup|modal|overlay|pagination|pager|widget|toolbar"
    r"|login|signup|search)(?:$|[\s_-])", re.IGNORECASE)
#: Class words like has-sidebar say what is beside or in a page's wrapper.
_MODIFIER = re.compile(r"(?:has|have|no|not|with|without|is|hide|show)[_-]", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""",
                        re.IGNORECASE)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?:{_RAW})(?=[\s/])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<skip>{_SKIPPED})(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>"
    rf"|</(?P<skipped>{_SKIPPED})\s*>"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/<>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<loose>/)?(?P<ltag>[a-zA-Z][^\s/<>]*)[^<>]*>"
    r"|<[!?][^<>]*>"
    r"|(?P<text>[^<]+|<)", re.DOTALL | re.IGNORECASE)


class Element:
    """An open element: its container features, and what it holds."""

    __slots__ = ("tag", "parent", "features", "hidden", "marked", "first", "last", "words", "holds")

    def __init__(self, tag: str, parent: int, first: int):
        self.tag, self.parent, self.first, self.last = tag, parent, first, None
        self.features, self.hidden, self.marked, self.words, self.holds = [], False, False, 0, False


def guess(feature: str) -> bool:
    """Whether a container feature speaks for other matter before anything is learned."""
    name = feature[1:]
    if feature[0] == "@":
        return True
    if feature[0] == "=":
        return name in _ROLES
    return bool(_MARKED.search(name)) and not _MODIFIER.match(name)


def skipped_ends(page: str) -> dict[int, int]:
    """Where the skipped elements that are closed end, by where their start tag ends.
    An end belongs to the last start of its name that is open."""
    open_: dict[str, list[int]] = {}
    out = {}
    for m in _TOKEN.finditer(page):
        if m["skip"] and not m[0].endswith("/>"):
            open_.setdefault(m["skip"].lower(), []).append(m.end())
        elif m["skipped"] and open_.get(m["skipped"].lower()):
            out[open_[m["skipped"].lower()].pop()] = m.end()
    return out


def tokens(page: str) -> tuple[list[tuple[str, str, int]], list[Element]]:
    """(tag or "", text, element that it stands in) of a page, and its elements
    in the order they open; a closing tag is "/name". Tags' text is empty."""
    out: list[tuple[str, str, int]] = []
    elements = [Element("", -1, -1)]     # the page itself
    stack: list[int] = [0]
    inside = 0                           # open articles
    held: list[str] = []                 # of the last token, if it is text

    def close_text() -> None:
        text = "".join(held)
        elements[out[-1][2]].words += len(text.split())
        out[-1] = ("", text, out[-1][2])
        held.clear()

    ends = skipped_ends(page)
    upto = 0
    for m in _TOKEN.finditer(page):
        if m.start() < upto:
            continue
        if m["skip"]:
            upto = ends.get(m.end(), 0)
            continue
        text = m["text"]
        if text is not None:
            if not held:
                out.append(("", "", stack[-1]))
            held.append(text)
            continue
        tag = (m["tag"] or m["ltag"] or "").lower()
        if not tag:
            continue
        if held:
            close_text()
        if m["close"] or m["loose"]:
            if any(elements[e].tag == tag for e in stack):
                while True:
                    e = elements[stack.pop()]
                    e.last = len(out)
                    inside -= e.tag in ("article", "main")
                    if e.tag == tag:
                        break
            out.append(("/" + tag, "", stack[-1]))
            continue
        here = Element(tag, stack[-1], len(out))
        # by itself in a paragraph of an article, a label or button is a part of its sentence
        inline = tag in ("label", "button") and inside and any(elements[e].tag == "p" for e in stack) and not any(
            elements[e].tag in ("form", "fieldset") for e in stack)
        if (tag in _OTHER and not inline) or (tag == "header" and not inside):
            here.features.append("@" + tag)
        rest = m["rest"] or ""
        if "=" in rest or "hidden" in rest:
            for name, *values in _ATTRIBUTE.findall(rest):
                value = "".join(values).strip().lower()
                name = name.lower()
                if name == "hidden" or (name == "aria-hidden" and value == "true"):
                    here.hidden = True
                elif name == "role":
                    here.features.append("=" + value)
                elif name in ("class", "id"):
                    words = ["." + w for w in value.split()]
                    if tag not in ("html", "body", "article", "main"):
                        here.features += words
                    here.marked |= any(map(guess, words))
        if tag not in _VOID and not rest.rstrip().endswith("/"):
            stack.append(len(elements))
            inside += tag in ("article", "main")
            out.append((tag, "", len(elements)))
            elements.append(here)
        else:
            out.append((tag, "", stack[-1]))
    if held:
        close_text()
    for e in reversed(elements):   # what is open at the end, ends there; elements report to their parents
        e.last = len(out) if e.last is None else e.last
        if e.parent >= 0:
            above = elements[e.parent]
            above.words += e.words
            above.holds |= e.holds or (e.tag in ("article", "main") and not e.marked)
    return out, elements


def other_matter(elements: list[Element], weights: dict[str, float]) -> list[float]:
    """How surely each element is of other matter, by itself or by one around it."""
    rooted, total = elements[0].holds, elements[0].words
    share = []
    for e in elements:
        found = 0.0
        if not e.holds:
            # without an article, neither a class nor a form round it makes nearly all of the page other matter
            wrapper = not rooted and e.words > NEARLY_ALL * total
            for f in e.features:
                if not wrapper or (f[0] == "@" and f != "@form"):
                    found = max(found, weights.get(f, float(guess(f))))
            if e.hidden:
                found = 1.0
        share.append(max(found, share[e.parent]) if e.parent >= 0 else found)
    return share


def word_score(share: float) -> float:
    return WORD_IN - (WORD_IN - WORD_OUT) * share


def kind(tag: str, other: bool) -> str:
    return tag.lstrip("/") + ("*" if other else "")


def label(page: str) -> Counter:
    """Counts of (kind or container feature, outside of the article) of a labelled page, else none."""
    found, elements = tokens(page)
    names = [t for t, _, _ in found]
    for root in ("article", "main"):
        if names.count(root) == 1 and names.count("/" + root) == 1:
            a, b = names.index(root), names.index("/" + root)
            other = [word_score(p) <= 0 for p in other_matter(elements, {})]
            counts = Counter((kind(t, other[e]), not a < i < b) for i, (t, _, e) in enumerate(found) if t)
            for e in elements[1:]:
                outside = e.last < a or e.first > b
                within = a < e.first < b
                # an advert in an article is no content for that; what holds the article is
                counts.update((f, outside) for f in set(e.features) if not (within and guess(f)))
            return counts
    return Counter()


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Score of each kind of tag, and share of other matter of containers' features
    (@tag, =role, .class word), from the sampled pages of least id hash."""
    prepare(pages.sparkSession)
    share = 1.5 * SAMPLE_PAGES / max(pages.count(), 1)   # hashes far above the bound aren't sorted
    sample = pages.filter(F.col("html").isNotNull()).select("html", F.xxhash64("page_id").alias("h"))
    sample = (sample if share >= 1 else sample.filter(F.col("h") < F.lit(int((share - 0.5) * 2.0 ** 64)))) \
        .orderBy("h", F.xxhash64("html")).limit(SAMPLE_PAGES).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for page in batch.column("html").to_pylist():
                total.update(label(page))
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.string()), pa.array([o for _, o in keys], pa.bool_()),
                 pa.array([total[k] for k in keys], pa.int64())], ["kind", "outside", "n"])

    seen = (sample.mapInArrow(lean(run), "kind string, outside boolean, n long").groupBy("kind")
              .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("outside"), F.col("n")).otherwise(0)).alias("out")))
    container = F.substring("kind", 1, 1).isin("@", "=", ".")
    learned = {}
    for rows, most in ((~container, MAX_KINDS), (container, MAX_CONTAINERS)):
        for r in seen.filter(rows).orderBy(F.desc("n"), "kind").limit(most).collect():
            learned[r.kind] = (r.out + GUESS * guess(r.kind)) / (r.n + GUESS) if r.kind[0] in "@=." \
                else OUTSIDE * r.out / (r.n + 1)
    return learned


def best_run(scores: list[float]) -> tuple[int, int]:
    """[a, b) of greatest sum, the shortest and first of equals; (0, 0) if none is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    found, elements = tokens(page)
    share = other_matter(elements, weights)
    score = [word_score(p) for p in share]
    scores = []
    for tag, text, e in found:
        if tag:
            scores.append(weights.get(kind(tag, score[e] <= 0), OUTSIDE if score[e] <= 0 else UNSEEN))
        else:
            scores.append(len(text.split()) * score[e])
    a, b = best_run(scores)
    roots = [e for i, e in enumerate(elements) if e.tag == "article" and not e.marked and score[i] > 0] or \
        [e for i, e in enumerate(elements) if e.tag == "main" and score[i] > 0]
    if a < b:   # short blocks up to the article's bounds belong to it
        first = min((e.first for e in roots if e.first < a <= e.last), default=a)
        last = max((e.last for e in roots if e.first < b <= e.last), default=b)
        a, b = first, last
    parts = []
    for tag, text, e in found[a:b]:
        if tag:
            if score[e] <= 0 or tag.lstrip("/") in _BLOCK:
                parts.append(" ")
        elif score[e] > 0:
            parts.append(entities.unescape(text))
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    prepare(pages.sparkSession)
    own = learn_weights(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, own) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        lean(run), "page_id long, url string, text string, n_chars long")
