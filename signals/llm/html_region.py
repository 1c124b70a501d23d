"""Main text of web pages: the contiguous region with the greatest score.

A page is read as a sequence of tags and words. Words score by the log-odds that words of their
surroundings stand in content, tags score below nothing by the log-odds of their kind, both
learned from pages whose own markup labels the content (one <article> or <main>); a prior of
`prior_words` words a feature stands in for what those pages do not show. Words and tags inside an
<article> or <main> have scores of their own, so links, lists, tables and images within it do not cut
the text off. One linear scan finds the best contiguous region. Inside it, parts that are never content (menus, forms, adverts,
reader comments and so on) are left out. Weights are counted over all labelled pages by partial
aggregation and are one row per feature of a closed list, whatever the number of pages.

A script, style, iframe, textarea, title or noscript without an end tag takes the rest of the page with
it, as in browsers; any other tag without one loses nothing, and a self-closed svg holds nothing.
Open tags are kept with what is above them, so deep or broken markup takes linear time.

Null or empty html gives empty text. Rows that repeat an id are each returned. With no labelled
page the priors decide. An empty table gives no rows. Other columns are not read.
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

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(<)|[^<]+",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "select"}
#: Those that take the rest of the page when they are never closed.
SWALLOW = {"script", "style", "noscript", "textarea", "iframe", "title"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "option",
}
#: Elements that never hold content.
APART = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "head"}
#: Words that mark a part as apart from the content: a whole class, id or role, or its leading word.
APART_NAMES = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus",
    "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "popup", "promo", "promoted", "related", "replies", "reply", "respond",
    "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
    "subscription", "widget", "toolbar", "pagination", "pager", "login", "signup", "alert",
}
#: What may follow such a leading word inside labelled content: "related-posts" is apart there,
#: "related-work" is not.
APART_TAILS = {
    "area", "articles", "bar", "block", "box", "button", "buttons", "container", "content", "form",
    "inner", "item", "items", "links", "list", "panel", "placeholder", "posts", "section", "slot", "space",
    "stories", "thread", "title", "unit", "widget", "wrap", "wrapper", "zone",
}
CONTENT_NAMES = {"article", "main", "content", "post", "entry", "story", "body", "text"}
#: A word inside one closes them in turn, as parsers do.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - {"br", "option"}

#: Score before any page is seen: words by surroundings, tags by kind.
PRIOR = {
    "word:p": 2.0, "word:heading": 1.0, "word:list": 0.8, "word:quote": 1.5, "word:pre": 1.5,
    "word:cell": 0.5, "word:other": 0.5, "word:link": -1.5,
    "tag:inline": -0.1, "tag:link": -1.0, "tag:p": -0.1, "tag:heading": -0.5, "tag:list": -0.5,
    "tag:box": -1.5, "tag:cell": -0.3, "tag:apart": -3.0, "tag:content": -0.1, "tag:other": -0.5,
}
#: The same inside labelled content: every word counts for it, and tags cost next to nothing.
PRIOR |= {
    f"{feature}:in": -0.02 if feature.startswith("tag:") else max(1.0, score)
    for feature, score in PRIOR.items()
}
KIND = {
    **dict.fromkeys(["p", "br"], "p"), **{f"h{i}": "heading" for i in range(1, 7)},
    **dict.fromkeys(["ul", "ol", "li", "dl", "dt", "dd"], "list"),
    **dict.fromkeys(["blockquote", "q"], "quote"), "pre": "pre",
    **dict.fromkeys(["td", "th", "tr", "table", "tbody", "thead", "caption"], "cell"),
    **dict.fromkeys(["div", "section", "body", "html"], "box"),
    **dict.fromkeys(["article", "main"], "content"), "a": "link",
}
APART_KIND, LABEL = "apart", {"article", "main"}


def attributes(source: str) -> dict[str, str]:
    """Values by name in small letters; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), "".join(values))
    return out


def apart_names(tag: str, given: dict[str, str], inside: bool) -> set[str]:
    """The words of APART_NAMES that a tag's class, id or role stands under.

    Headings, paragraphs and inline tags inside labelled content have none, and their ids never
    count: those are anchors. Nor does the leading word of an id inside labelled content; that of a
    class counts there before words of APART_TAILS only."""
    small = tag not in BLOCKS or tag == "p" or KIND.get(tag) == "heading"
    if small and inside:
        return set()
    found = set()
    for attribute in ("class", "id", "role"):
        if attribute == "id" and small:
            continue
        for token in given.get(attribute, "").split():
            found.add(token.lower())
            first, *tail = [w.lower() for w in NAME_PART.findall(token)] or [""]
            if not inside or (attribute != "id" and all(w in APART_TAILS or w.isdigit() for w in tail)):
                found.add(first)
    return found & APART_NAMES


class Open:
    """An open element, with what holds for everything in it."""

    __slots__ = ("tag", "kind", "apart", "labelled", "link", "near")

    def __init__(self, tag: str, kind: str, apart: bool, above: Open | None):
        self.tag, self.kind = tag, kind
        self.apart = apart or (above is not None and above.apart)
        self.labelled = tag in LABEL or (above is not None and above.labelled)
        self.link = kind == "link" or (above is not None and above.link)
        self.near = kind if f"word:{kind}" in PRIOR else above.near if above is not None else "other"


class Page:
    """Events of a page: (feature, text or None, block number, inside labelled content)."""

    def __init__(self, source: str):
        self.events: list[tuple[str, str | None, int, bool]] = []
        self.stack: list[Open] = []
        self.open: Counter = Counter()  # tags on the stack
        self.block, self.labels = 0, 0
        endless: set[str] = set()  # raw tags with no end tag ahead
        at = 0
        while m := TOKEN.match(source, at):
            at = m.end()
            tag = (m[1] or "").lower()
            if tag and m[0][1] == "/":
                self._end(tag)
            elif tag:
                self._start(tag, m[2] or "")
                if tag in RAW and not (tag == "svg" and (m[2] or "").rstrip().endswith("/")):
                    # Only its own end tag ends it.
                    end = None
                    if tag not in endless:
                        end = re.compile(f"</{tag}[\\s/>]", re.IGNORECASE).search(source, at)
                    if end:
                        at = end.start()
                    elif tag in SWALLOW:
                        at = len(source)
                    else:
                        endless.add(tag)
            elif m[0][0] != "<" or m[3]:
                self._text(m[0])

    def _above(self) -> Open | None:
        return self.stack[-1] if self.stack else None

    def _apart(self) -> bool:
        return bool(self.stack) and self.stack[-1].apart

    def _labelled(self) -> bool:
        return bool(self.stack) and self.stack[-1].labelled

    def _pop(self) -> Open:
        last = self.stack.pop()
        self.open[last.tag] -= 1
        return last

    def _event(self, feature: str, text: str | None) -> None:
        inside = self._labelled()
        self.events.append((f"{feature}:in" if inside else feature, text, self.block, inside))

    def _emit_tag(self, kind: str) -> None:
        if not self._apart():  # a part left out costs its two outer tags, however large it is
            self._event(f"tag:{kind if f'tag:{kind}' in PRIOR else 'other'}", None)

    def _start(self, tag: str, source: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        if tag in VOID and self._labelled():  # images and line breaks in an article cost nothing
            return
        if tag in RAW or tag in VOID:
            self._emit_tag(KIND.get(tag, "inline"))
            return
        if tag in ENDS_P and any(o.tag == "p" for o in self.stack[-3:]):
            while self.stack and any(o.tag == "p" for o in self.stack[-3:]):
                self._pop()
        elif tag in CLOSES and self.stack and self.stack[-1].tag in CLOSES[tag]:
            self._pop()
        given = attributes(source) if source.strip() else {}
        names = {
            part.lower()
            for name in ("class", "id", "role")
            for part in NAME_PART.findall(given.get(name, ""))
        }
        inside = self._labelled()
        marks = apart_names(tag, given, inside) if names else set()
        if tag == "header" and inside:  # an article's own header holds its headline
            apart = bool(marks - {"header"})
        else:
            marked = bool(marks) and not names & {"article", "main", "story"}
            apart = tag in APART or (marked and tag not in LABEL | {"body", "html"})
        if "hidden" in given or NOT_SHOWN.search(given.get("style", "")):
            apart = True
        kind = APART_KIND if apart else KIND.get(tag, "inline" if tag not in BLOCKS else "other")
        if tag in LABEL and not self._apart():
            self.labels += not inside
        if tag == "div" and names & CONTENT_NAMES and not apart:
            kind = "content"
        self._emit_tag(kind)
        self.stack.append(Open(tag, kind, apart, self._above()))
        self.open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        if self.open[tag] > 0:
            while (last := self._pop()).tag != tag:
                pass
            self._emit_tag(last.kind)

    def _text(self, text: str) -> None:
        if self._apart():
            return
        above = self._above()
        near = "other" if above is None else "link" if above.link else above.near
        self._event(f"word:{near}", html.unescape(text))

    def best(self, weights: dict[str, float]) -> tuple[int, int]:
        """First and last event (exclusive) of the region with the greatest score."""
        top, where, run, start = 0.0, (0, 0), 0.0, 0
        for i, (feature, text, _, _) in enumerate(self.events):
            run += weights[feature] * (len(text.split()) if text is not None else 1)
            if run <= 0:
                run, start = 0.0, i + 1
            elif run > top:
                top, where = run, (start, i + 1)
        return where

    def main_text(self, weights: dict[str, float]) -> str:
        start, end = self.best(weights)
        parts: list[str] = []
        last = None
        for _, text, block, _ in self.events[start:end]:
            if text is not None:
                if last is not None and block != last:
                    parts.append(" ")
                parts.append(text)
                last = block
        return " ".join("".join(parts).split())

    def counts(self) -> Counter:
        """(feature, inside labelled content): words or tags; nothing unless one part is labelled.

        What is inside also counts for the scores of pages without labels."""
        out: Counter = Counter()
        if self.labels == 1:
            for feature, text, _, inside in self.events:
                n = len(text.split()) if text is not None else 1
                out[feature, inside] += n
                if inside:
                    out[feature.removesuffix(":in"), inside] += n
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for source in batch.column(0):
            total.update(Page(source.as_py() or "").counts())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([f for f, _ in total], pa.string()),
            pa.array([i for _, i in total], pa.bool_()),
            pa.array(list(total.values()), pa.int64()),
        ],
        names=["feature", "inside", "n"],
    )


def learn_weights(pages: DataFrame, prior_words: float = 50.0) -> dict[str, float]:
    """Score of every feature: log-odds in labelled pages, drawn to the prior by `prior_words`.

    Tags stay between their prior and twice that, so they always cost something, yet pages built
    otherwise than the labelled ones keep their content."""
    counted = (
        pages.select("html")
        .mapInArrow(_count, "feature string, inside boolean, n long")
        .groupBy("feature", "inside")
        .agg(F.sum("n").alias("n"))
    )
    seen: dict[tuple[str, bool], int] = {(r.feature, r.inside): r.n for r in counted.collect()}
    weights = {}
    for feature, prior in PRIOR.items():
        p = 1 / (1 + math.exp(-prior))
        inside = seen.get((feature, True), 0) + prior_words * p
        outside = seen.get((feature, False), 0) + prior_words * (1 - p)
        score = max(-6.0, min(3.0, math.log(inside / outside)))
        weights[feature] = max(min(score, prior), 2 * prior) if feature.startswith("tag:") else score
    return weights


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(s.as_py() or "").main_text(weights) for s in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


def op7(pages: DataFrame) -> DataFrame:
    return extract(pages, learn_weights(pages))
