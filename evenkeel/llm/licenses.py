"""License scans: exact phrases, and short notices found with a bounded number of edits.

A notice that occurs with at most k edits (letters inserted, deleted or replaced) keeps at
least one of any k + 1 pieces it is cut into unharmed. So one pass of an Aho-Corasick automaton
over the whole text finds every piece, each piece names a stretch of text that may hold its
notice, and only there the ``regex`` module looks for the notice within k edits. A
stretch is searched for its best match, then before and behind that, until nothing within k edits is left. Texts
without a piece cost one pass.

Notices are sought in the text's words joined by single blanks, so line breaks and punctuation
between words don't count as edits. Spans are word positions, ends exclusive.

Cases: a NULL text is the empty text: no words, no labels, score 0. Repeated places are
all counted. Every row is scanned by itself, so repeated rows give repeated results.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table

WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: fixed by the contract: words that must follow each other, and their label
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: short notices as words in lower case, and their label
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license version 3": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
#: one edit for so many letters of a notice
LETTERS_PER_EDIT = 10
MOST_EDITS = 4


@dataclass(frozen=True)
class Span:
    """A notice or phrase found: words ``start`` to ``end`` (exclusive), and how many edits it took."""

    label: str
    start: int
    end: int
    edits: int
    likeness: float


def edits_allowed(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // LETTERS_PER_EDIT)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): the notice cut into ``edits`` + 1 pieces of nearly equal length."""
    cuts = [len(notice) * n // (edits + 1) for n in range(edits + 2)]
    return [(begin, notice[begin:end]) for begin, end in zip(cuts, cuts[1:], strict=False)]


class NoticeSearch:
    """Searches word-joined texts for all notices; built once per Python worker."""

    def __init__(self, notices: dict[str, str]):
        self.notices = [(text, label, edits_allowed(text)) for text, label in notices.items()]
        self.patterns = [
            regex.compile(f"(?b)(?<![^ ])(?:{regex.escape(text)}){{e<={edits}}}(?![^ ])") for text, _, edits in self.notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (text, _, edits) in enumerate(self.notices):
            for offset, piece in pieces(text, edits):
                seeds.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (piece, owners))
        self.automaton.make_automaton()

    def regions(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Stretches of text that may hold a notice, merged where they overlap, by notice."""
        found: dict[int, list[tuple[int, int]]] = {}
        for last, (piece, owners) in self.automaton.iter(text):
            for number, offset in owners:
                notice, _, edits = self.notices[number]
                begin = last - len(piece) + 1 - offset
                found.setdefault(number, []).append((max(0, begin - edits - 1), begin + len(notice) + edits + 1))
        return {number: _merged(stretches) for number, stretches in found.items()}

    def find(self, words: list[str]) -> list[Span]:
        """The spans found; of notices that overlap, the one most like its text."""
        text = " ".join(words)
        starts: list[int] = []
        out = []
        for number, held in self.regions(text).items():
            notice, label, _ = self.notices[number]
            for begin, end in held:
                blank = text.find(" ", end)  # a stretch doesn't end inside a word
                for match in _matches(self.patterns[number], text, begin, len(text) if blank < 0 else blank):
                    starts = starts or [0, *accumulate(len(word) + 1 for word in words)]
                    edits = sum(match.fuzzy_counts)
                    first, last = bisect_right(starts, match.start()) - 1, bisect_right(starts, match.end() - 1) - 1
                    out.append(Span(label, first, last + 1, edits, 1 - edits / len(notice)))
        kept: list[Span] = []
        for span in sorted(out, key=lambda span: (-span.likeness, span.start, span.start - span.end, span.label)):
            place = bisect_left(kept, span.start, key=lambda held: held.start)
            free = place == 0 or kept[place - 1].end <= span.start
            if free and (place == len(kept) or span.end <= kept[place].start):
                kept.insert(place, span)
        return kept


def _matches(pattern: regex.Pattern, text: str, begin: int, end: int) -> Iterator[regex.Match]:
    """All matches in a stretch: the best one, then those before and behind it."""
    parts = [(begin, end)]
    while parts:
        low, high = parts.pop()
        match = pattern.search(text, low, high) if low < high else None
        if match and match.end() > match.start():
            yield match
            parts += [(match.end(), high), (low, match.start())]


def _merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(stretches):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


class PhraseSearch:
    """All places where the words of a phrase stand one after the other."""

    def __init__(self, phrases: dict[str, str]):
        self.phrases = [(phrase.encode().split(), label) for phrase, label in phrases.items()]
        self.patterns = [
            re.compile(rb"(?<![^\x00-\x2F\x3A-\x60\x7B-\x7F])" + BETWEEN.join(words) + rb"(?![^\x00-\x2F\x3A-\x60\x7B-\x7F])")
            for words, _ in self.phrases
        ]

    def find(self, text: bytes) -> list[Span]:
        """Spans in a text in lower case; no phrase overlaps itself, so a plain search finds all places."""
        places = sorted(
            (match.start(), label, len(words))
            for (words, label), pattern in zip(self.phrases, self.patterns, strict=True)
            for match in pattern.finditer(text)
        )
        out, at, passed = [], 0, 0
        for start, label, size in places:
            passed += len(re.findall(WORD, text[at:start]))  # a phrase starts where a word starts
            at = start
            out.append(Span(label, passed, passed + size, 0, 1.0))
        return out


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:long,end:long,edits:long>>"
)


def scan_licenses(
    documents: DataFrame, text: Column, result: str, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None
) -> DataFrame:
    """The documents with a struct column of what was found; no shuffle, whole texts, one at a time."""
    phrases, notices = phrases or PHRASES, notices or NOTICES

    @F.pandas_udf(RESULT)
    def scan(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        exact, fuzzy = PhraseSearch(phrases), NoticeSearch(notices)
        for values in series:
            yield pd.DataFrame([_scan_one(value, exact, fuzzy) for value in values], columns=COLUMNS)

    return documents.withColumn(result, scan(text))


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def _scan_one(value: str | None, exact: PhraseSearch, fuzzy: NoticeSearch) -> tuple:
    text = (value or "").encode("utf-8", "surrogatepass").lower()
    words = re.findall(WORD, text)
    base = exact.find(text)
    near = fuzzy.find([word.decode("utf-8", "surrogatepass") for word in words])
    starts = [span.start for span in base]
    spans = [{"label": x.label, "start": x.start, "end": x.end, "edits": x.edits} for x in [*base, *near]]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({span.label for span in base})),
        ",".join(sorted({span.label for span in [*base, *near]})),
        max((span.likeness for span in [*base, *near]), default=0.0),
        spans,
    )


def license_report(spark, sf_dir: str) -> DataFrame:
    """``op6``: the licenses named in every document."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licenses(documents, F.col("text"), "found")
    return found.select("doc_id", *(F.col("found")[name].alias(name) for name in COLUMNS if name != "spans"))
