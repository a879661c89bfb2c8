"""Main text of web pages by maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words have positive weights
where they look like content and tags negative ones; one linear scan finds the
contiguous region with the greatest sum. The weights are log-odds counted on
labelled pages: pages whose author marked the content with one ``article`` or
``main`` element. Word weights depend on the enclosing block and on whether
the word is in a link, and, in pages that have a marked element, on whether
the word is inside it.

Elements that never hold the article's own text (menus, forms, notices,
adverts, reader comments, ...), by tag name or by a class, id or role that
names such a part, are taken out of the sequence, inside the region too. A
name of several words counts by its last one (``cookie-notice``), or by its
first one before a word for a container (``comment-list``): ``comment-policy``,
``notice-free`` and ``has-sidebar`` say something else. An element that by its
class would take away more than half of the page's words is a wrapper, and
stays.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vehicle_metrics.llm.common import add_columns, text_blocks
from vehicle_metrics.storage import materialize

CLASSES = 2_000  # word and tag classes with a weight of their own; the rarer ones are pooled

# Roles of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("head nav footer aside form script style noscript template iframe object svg canvas button select "
                    "textarea menu dialog fieldset audio video".split())
MARKED = frozenset(["article", "main"])
NEVER_BY_NAME = frozenset("html body article main".split())
BOILERPLATE = frozenset("""ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notices notification alert popup modal overlay sidebar comment comments disqus
discussion replies respond share sharing social related recommended breadcrumb breadcrumbs menu nav navigation navbar
footer masthead topbar toolbar subscribe subscription newsletter signup login search widget pagination pager skip
contentinfo complementary""".split())

#: Last words of names that say what kind of box a part is in, and first words that deny or describe.
CONTAINERS = frozenset("""area bar block blocks box button buttons card cards container content form group holder inner item items
label link links list message outer panel posts region row section slot space strip tabs text thread unit widget wrap wrapper""".split())
DENIALS = frozenset("has have no non not with without is hide hidden free enable disable".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][a-z0-9:-]*)(?P<attrs2>[^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z]+")


def _names_boilerplate(name: str, marked: bool) -> bool:
    """Whether a class, id or role, of one word or several, names a part that
    is not the article's own text."""
    words = PARTS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
    if not words or words[0] in DENIALS:
        return False
    while len(words) > 1 and words[-1] in CONTAINERS:
        words = words[:-1]
    return words[-1] in BOILERPLATE or (words[-1] == "header" and not marked)


def _boilerplate(attrs: str, marked: bool) -> bool:
    return any(_names_boilerplate(name, marked) for m in NAMED.finditer(attrs)
               for name in (m[2] or m[3] or m[4] or "").split())


def tokens(page: str) -> list[tuple[str, str | None, int]]:
    """(kind, text, words): for text, kind is the class of its words, text the
    raw characters and words their number; for a tag, kind is its name with
    ``<`` before and text is None."""
    spared: set[int] = set()
    while True:
        out, gone = _tokens(page, spared)
        if not gone:
            return out
        at = max(gone, key=gone.get)
        if 2 * gone[at] <= sum(n for _, _, n in out) + sum(gone.values()):
            return out
        spared.add(at)


def _tokens(page: str, spared: set[int]) -> tuple[list[tuple[str, str | None, int]], dict[int, int]]:
    """``tokens``, and how many words each element took away that was dropped
    for its class, by where it begins; those in ``spared`` are kept."""
    out: list[tuple[str, str | None, int]] = []
    gone: dict[int, int] = {}
    dropped_at = -1
    dropped, depth, inner, marked, links, block = "", 0, 0, 0, 0, "body"
    low = page.lower()
    marks = sum(low.count(f"<{m}") for m in MARKED)
    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            if dropped:
                if dropped_at in gone:
                    gone[dropped_at] += len(text.split())
            else:
                kind = f"{block}{'+a' if links else ''}"
                out.append((f"{kind}@{'in' if marked else 'out'}" if marks else kind, text, len(text.split())))
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue  # comment, script, style, declaration
        closing, attrs = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if dropped:
            if name == dropped:
                depth += -1 if closing else 1
                if depth == 0:
                    dropped = ""
                continue
            # An element that was never closed ends where the content element around it ends, or where the page's only
            # content element begins. Content elements inside a closed one belong to it.
            if name in MARKED and (marked and not inner if closing else marks == 1 or f"</{dropped}" not in low[m.end():]):
                dropped, inner = "", 0
            elif name in MARKED:
                inner = max(0, inner + (-1 if closing else 1))
                continue
            elif name == "body" or (name == "html" and closing):
                dropped, inner = "", 0
            else:
                continue
        by_name = name in DROPPED or (name == "header" and not marked)
        if not closing and name not in VOID and (by_name or (
                name not in NEVER_BY_NAME and attrs and m.start() not in spared and _boilerplate(attrs, bool(marked)))):
            if not attrs.rstrip().endswith("/"):
                dropped, depth, inner, dropped_at = name, 1, 0, m.start()
                if not by_name:
                    gone[dropped_at] = 0
            out.append(("<" + name, None, 0))
            continue
        if name in MARKED:
            marked = max(0, marked + (-1 if closing else 1))
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        elif name not in INLINE and name not in VOID:
            block, links = ("body" if closing else name), 0
        out.append(("<" + name, None, 0))
    return out, gone


class Weights:
    """Log-odds of word and tag classes. A class without counts has those of
    the pool of rare classes of its kind (see ``pool``), and without these a
    word weighs 1 (-3 outside the marked element) and a tag -1; a tag is never
    positive."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        inside = sum(a for a, _ in counts.values()) + 1
        outside = sum(b for _, b in counts.values()) + 1
        self.of = {k: math.log((a + 0.5) / inside) - math.log((b + 0.5) / outside) for k, (a, b) in counts.items()}

    def score(self, kind: str, words: int) -> float:
        if kind[0] == "<":
            return min(self.of.get(kind, self.of.get(pool(kind), -1.0)), -0.1)
        return words * self.of.get(kind, self.of.get(pool(kind), -3.0 if kind.endswith("@out") else 1.0))


def pool(kind: str) -> str:
    """The pool that a rare class belongs to: tags, or words by what follows
    their block's name."""
    return "<*" if kind[0] == "<" else "*" + "".join(x for x in ("+a", "@in", "@out") if x in kind)


def label_counts(page: str) -> Counter:
    """(class, inside) counts of a labelled page; empty for a page that does
    not have exactly one marked element."""
    found: Counter = Counter()
    low = page.lower()
    if sum(len(re.findall(rf"<{m}\b", low)) for m in MARKED) != 1:
        return found
    marked = False
    for kind, text, words in tokens(page):
        if text is None:
            if kind[1:] in MARKED:
                marked = not marked
            else:
                found[kind, marked] += 1
        elif words:
            plain = kind.partition("@")[0]
            found[plain, marked] += words
            found[kind, marked] += words
    return found


def best_region(scores: list[float]) -> tuple[int, int]:
    """(start, end) of the contiguous range with the greatest positive sum,
    the first such range; (0, 0) if no score is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str, weights: Weights) -> str:
    """The text of the best region: character references decoded, white space
    within a block turned into one space, blocks joined by one space."""
    seq = tokens(page)
    a, b = best_region([weights.score(kind, words) for kind, _, words in seq])
    blocks, now = [], []
    for kind, text, _ in seq[a:b]:
        if text is not None:
            now.append(html.unescape(text))
        elif kind[1:] not in INLINE:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    return " ".join(" ".join(x.split()) for x in blocks if x and not x.isspace())


def learn_weights(pages: DataFrame, html_col: str, classes: int = CLASSES) -> Weights:
    """Class counts over all labelled pages: the commonest ``classes`` on
    their own, the others in pools, so the table has a fixed size."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, texts in text_blocks(batches, "body"):
            for t in texts:
                total.update(label_counts(t.decode("utf-8", "replace")))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_()),
             pa.array(list(total.values()), pa.int64())], names=["kind", "inside", "n"])

    pooled = "CASE WHEN startswith(kind, '<') THEN '<*' ELSE concat('*', regexp_extract(kind, '([+]a)?(@in|@out)?$', 0)) END"
    counts = materialize(
        pages.select(F.col(html_col).alias("body")).mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind")
        .agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
             F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("b")), "page_classes")
    top = counts.orderBy(F.desc(F.col("a") + F.col("b")), "kind").limit(classes).collect()
    rest = (counts.where(~F.col("kind").isin([r.kind for r in top])).groupBy(F.expr(pooled).alias("kind"))
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect() if len(top) == classes else [])
    return Weights({r.kind: (r.a, r.b) for r in [*top, *rest]})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every page.

    NULL and empty pages, and pages without a region of positive weight, get
    an empty text. Pages may lack end tags and may be cut off anywhere. Where
    no page is labelled, words weigh 1 and tags -1. Repeated rows each get a
    row; other columns are not carried.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("address"),
                        F.col(html_col).cast("string").alias("body"))
    weights = learn_weights(rows, "body")
    shared = pages.sparkSession.sparkContext.broadcast(weights.of)

    def compute():
        mine = Weights({})
        mine.of = shared.value
        return lambda texts: [pa.array([main_text(t.decode("utf-8", "replace"), mine) for t in texts], pa.string())]

    return add_columns(rows, "body", StructType([StructField("content", StringType())]), compute).select(
        F.col("id").alias(id_col), F.col("address").alias(url_col), F.col("content").alias("text"),
        F.length("content").cast("long").alias("n_chars"))
