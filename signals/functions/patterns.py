r"""Whole-word markers in a text, as Spark column expressions.

The rules treat every Unicode letter, digit and underscore as part of a word. Java's own
``\b`` and ``\w`` also count combining marks such as the emoji variation selector, so the
classes are spelled out.

A text is cut into words once, and only the words that some list knows are kept (one look
into a hash set a word): every list is then looked up in those few. Stems (``livr\w*``) are
found among them too, a multi-word pattern is only searched in the text when a word it cannot
do without is there, and one that begins with fixed letters or a digit only when they are. Looking every
list up in all words costs several times more, scanning the text once per list more still.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
START, END = rf"(?<![{WORD}])", rf"(?![{WORD}])"
EDGE = rf"(?:{START}(?=[{WORD}])|(?<=[{WORD}]){END})"
SPACE = r"[\s\x{85}\p{Z}]"


def to_java(pattern: str) -> str:
    for short, full in (
        (r"\b.*\b", rf"{END}[^\n]*{START}"),
        (r"\b", EDGE),
        (r"\w", f"[{WORD}]"),
        (r"\W", f"[^{WORD}]"),
        (r"\s", SPACE),
        (r"\d", r"\p{Nd}"),
    ):
        pattern = pattern.replace(short, full)
    return pattern


def whole_words(patterns: Iterable[str]) -> str:
    """Alternation of the patterns, ending at a word edge; the start is left to the caller."""
    patterns = list(patterns)
    # A fragment ending in a symbol has no word edge there.
    open_ended = [p for p in patterns if p.endswith("@")]
    closed = [p for p in patterns if not p.endswith("@")]
    parts = [f"(?:{'|'.join(closed)}){END}"] if closed else []
    return to_java("|".join(parts + open_ended))


def any_of(patterns: Iterable[str]) -> str:
    """Matches any of the patterns as whole words; the character before is consumed."""
    return f"(?:[^{WORD}]|^)(?:{whole_words(patterns)})"


def _spellings(items) -> list[str] | None:
    """Every text a parsed fragment can stand for, or None when there is no end to them."""
    out = [""]
    for kind, value in items:
        if kind is op.LITERAL:
            more = [chr(value)]
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            more = [chr(code) for _, code in value]
        elif kind is op.SUBPATTERN:
            more = _spellings(value[3])
        elif kind is op.BRANCH:
            branches = [_spellings(branch) for branch in value[1]]
            more = None if None in branches else list(itertools.chain(*branches))
        elif kind is op.MAX_REPEAT and value[:2] == (0, 1):
            inner = _spellings(value[2])
            more = None if inner is None else ["", *inner]
        else:
            more = None
        if more is None:
            return None
        out = [a + b for a in out for b in more]
    return out


def _is_gap(kind, value) -> bool:
    """Does the item always part two words: a word edge, or one or more spaces?"""
    if kind is op.AT:
        return True
    return kind is op.MAX_REPEAT and value[0] >= 1 and "CATEGORY_SPACE" in str(value[2])


def _required_words(pattern: str) -> list[str] | None:
    """Words of which one must be present for the pattern to match; None if unknown."""
    runs, current = [], []
    for kind, value in parser.parse(pattern):
        if _is_gap(kind, value):
            runs.append(current)
            current = []
        else:
            current.append((kind, value))
    runs.append(current)
    choices = []
    for run in runs:
        texts = _spellings(run)
        if texts:
            longest = [max(re.findall(r"\w+", t), key=len, default="") for t in texts]
            if all(longest):
                choices.append(longest)
    return max(choices, key=lambda words: min(map(len, words)), default=None)


@dataclass(frozen=True)
class Markers:
    """A pattern list sorted by how each pattern is looked up."""

    words: tuple[str, ...]
    stems: tuple[str, ...]
    phrases: tuple[str, ...]
    anchors: tuple[str, ...]
    free: tuple[str, ...]

    @staticmethod
    def of(patterns: Iterable[str]) -> Markers:
        words, stems, phrases, anchors, free = [], [], [], [], []
        for pattern in patterns:
            texts = _spellings(parser.parse(pattern))
            stem = _spellings(parser.parse(pattern[:-3])) if pattern.endswith(r"\w*") else None
            needed = _required_words(pattern)
            if texts and all(re.fullmatch(r"\w+", t) for t in texts):
                words += texts
            elif stem and all(re.fullmatch(r"\w+", t) for t in stem):
                stems += stem
            elif needed:
                phrases.append(pattern)
                anchors += needed
            else:
                free.append(pattern)
        parts = (words, stems, phrases, anchors, free)
        return Markers(*(tuple(dict.fromkeys(part)) for part in parts))


def text_words(text: Column) -> Column:
    return F.split(text, f"[^{WORD}]+")


def numeral(word: Column) -> Column:
    """Does the word begin with a digit? Those beyond ASCII come late in the order of characters."""
    return ((word >= "0") & (word < ":")) | ((word >= "\u0660") & word.rlike(r"^\p{Nd}"))


def among(words: Column, values: Iterable[str], stems: Iterable[str]) -> Column:
    """Those of the words that are among the values, may begin with one of the stems or are numerals."""
    stems = list(stems)
    length = min(map(len, stems))
    heads = {s[:length] for s in stems}
    return F.filter(
        words, lambda w: w.isin(*values) | F.substring(w, 1, length).isin(*heads) | numeral(w)
    )


def known_words(text: Column, values: Iterable[str], stems: Iterable[str]) -> Column:
    """The words of the text that some list may know, once each."""
    return F.array_distinct(among(text_words(text), values, stems))


def text_stems(words: Column, stems: Iterable[str]) -> Column:
    """The given stems that some word begins with."""
    joined = F.array_join(words, " ")
    return F.regexp_extract_all(joined, F.lit(f"(?:^| )({'|'.join(stems)})"), F.lit(1))


def has_word(words: Column, values: Iterable[str]) -> Column:
    return F.exists(words, lambda w: w.isin(*values))


def _opening(pattern: str) -> str:
    """The fixed letters a pattern begins with."""
    items = itertools.takewhile(lambda item: item[0] is op.LITERAL, parser.parse(pattern))
    return "".join(chr(code) for _, code in items)


def has_any(markers: Markers, text: Column, words: Column, stems: Column | None = None) -> Column:
    tests = []
    if markers.words:
        tests.append(has_word(words, markers.words))
    if markers.stems:
        tests.append(has_word(stems, markers.stems))
    if markers.phrases:
        found = text.rlike(any_of(markers.phrases))
        tests.append(has_word(words, markers.anchors) & found)
    for pattern in markers.free:
        found = text.rlike(any_of([pattern]))
        letters = _opening(pattern)
        if letters:
            found = text.contains(letters) & found
        elif pattern.startswith(r"\d"):
            found = F.exists(words, numeral) & found
        tests.append(found)
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def count_words(words: Column, values: Iterable[str]) -> Column:
    """How many of the values occur, each counted once."""
    return F.size(F.array_distinct(F.filter(words, lambda w: w.isin(*values))))
