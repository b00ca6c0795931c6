"""Operator 5, license scans by fuzzy short-notice search.

A notice of n characters that may differ by e edits is split into e + 1 pieces; wherever it stands with at most e edits, one
piece stands unchanged (pigeonhole). One automaton finds all pieces of all notices in a text, and only around its hits the
regex library's bounded-error matching looks for the notice itself, counts the edits and gives the span.

Texts are compared as their words (letters A-Z lower-cased, words joined by one blank), so case, line ends and punctuation
do not count as edits.

Names and versions that tell licenses apart ("mit", "2", "nc") must stand as they are; the edits fall on the other words.

Defined results: a null or empty text has no words, no labels (empty strings) and score 0; overlapping places count each;
equal places of several notices of one label give that label once; where labels tie with edits at one place, none is given; repeated
rows and rows without an id are scanned each for itself; a very long text is read whole, at a cost in proportion to its length, in its task's
memory; columns other than id and text are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import map_rows, table

#: Exact phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Short notices that are also found with some edits, with their labels. Words in braces tell a license from its rivals: they must
#: stand as they are.
NOTICES = {
    "licensed under the {mit} license": "mit",
    "released under the {mit} license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the {apache} license version {2} 0": "apache-2",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under {cc by nc} 4 0": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution 4 0 international": "cc-by",
    "gnu {general} public license version {3}": "gpl-3",
    "gnu {general} public license version {2}": "gpl-2",
    "gnu {lesser} general public license": "lgpl",
    "gnu {affero} general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "{mozilla} public license version {2}": "mpl-2",
    "dedicated to the public domain": "public-domain",
}
#: One edit is allowed for each so many characters of a notice.
CHARS_PER_EDIT, MAX_EDITS = 12, 4
_WORD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def plain(notice: str) -> str:
    return notice.replace("{", "").replace("}", "")


def edits_allowed(notice: str) -> int:
    return min(MAX_EDITS, len(plain(notice)) // CHARS_PER_EDIT)


def pieces(notice: str) -> list[tuple[int, str]]:
    """(offset, piece): one piece more than edits are allowed, of nearly equal length."""
    notice = plain(notice)
    k = edits_allowed(notice) + 1
    cuts = [round(i * len(notice) / k) for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def parts(notice: str) -> list[tuple[str, bool]]:
    """(text, exact) of a notice's parts; an exact part has the blanks around its words, so that they are whole words."""
    out = []
    for i, part in enumerate(re.split(r"[{}]", notice)):
        if part.strip():
            out.append((f" {part} ", True) if i % 2 else (part.strip(" "), False))
    return out


class Scanner:
    def __init__(self, notices: dict[str, str]):
        import ahocorasick
        import regex

        self.notices = [(plain(n), label, edits_allowed(n)) for n, label in notices.items()]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for at, piece in pieces(notice):
                found.setdefault(piece, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for piece, where in found.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()
        # BESTMATCH: of several matches the one with fewest edits. Each part may take all edits; their sum is checked afterwards, and
        # as the best match has the least, none is lost
        one = lambda text, exact, e: f"(?:{regex.escape(text, literal_spaces=True)})" + ("" if exact else f"{{e<={e}}}")
        self.patterns = [regex.compile("(?b)" + "".join(one(t, exact, e) for t, exact in parts(n))) for n, (_, _, e) in zip(notices, self.notices, strict=True)]

    def _regions(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(notice, from, to): where the notice can stand by its pieces. Windows that touch are one region; a long region is cut into
        stretches that overlap by more than a notice, so a text full of seeds costs in proportion to its length."""
        open_: dict[int, list[int]] = {}
        for end, (length, where) in self.seeds.iter(text):
            for i, at in where:
                notice, _, slack = self.notices[i]
                # an exact part takes in a blank on either side
                a = max(0, end - length - at - slack)
                b = min(len(text), end - length + 2 - at + len(notice) + slack)
                own = open_.get(i)
                if own and a <= own[1]:
                    own[0], own[1] = min(own[0], a), max(own[1], b)
                else:
                    if own:
                        yield from self._stretches(i, *own)
                    open_[i] = [a, b]
        for i, own in open_.items():
            yield from self._stretches(i, *own)

    def _stretches(self, i: int, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        overlap = len(self.notices[i][0]) + self.notices[i][2] + 4
        while b - a > 4 * overlap:
            yield i, a, a + 4 * overlap
            a += 3 * overlap
        yield i, a, b

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(label, start, end, edits, length of the notice) in ``text``, each place once."""
        out = []
        for i, begin, end in self._regions(text):
            notice, label, allowed = self.notices[i]
            # the best match of a stretch may stand behind others: both sides of it are searched
            todo = [(begin, end)]
            while todo:
                a, b = todo.pop()
                m = self.patterns[i].search(text, a, b)
                if m and sum(m.fuzzy_counts) <= allowed:
                    out.append((sum(m.fuzzy_counts), m.start(), m.end(), i, label, len(notice)))
                    todo += [(a, m.start()), (m.end(), b)]
        return _without_rivals(sorted(set(out)))


def _without_rivals(found: list[tuple[int, int, int, int, str, int]]) -> list[tuple[str, int, int, int, int]]:
    """Fewest edits first: where notices of several labels match the same place, the one with fewest edits is meant, and among equals that are
    not exact none; of one notice's matches that overlap the best stays. Matches are short, so each is compared with its own neighbourhood."""
    near: dict[int, list[tuple]] = {}
    kept, doubtful = [], set()
    for m in found:
        edits, a, b, i, label, length = m
        around = [k for cell in range((a >> 8) - 1, (b >> 8) + 2) for k in near.get(cell, ()) if k[1] < b and a < k[2]]
        if any(k[3] == i or (k[4] != label and k[0] < edits) for k in around):
            continue
        for k in around:
            if k[4] != label and k[0] == edits > 0:
                doubtful |= {m, k}
        near.setdefault(a >> 8, []).append(m)
        kept.append(m)
    return [(label, a, b, edits, length) for m in kept if m not in doubtful for edits, a, b, _, label, length in [m]]


def scan(raw: bytes | None, scanner: Scanner, base: dict[str, str]) -> tuple:
    words = (raw or b"").lower().translate(_WORD).decode("utf-8", "replace").split(" ")
    words = [w for w in words if w]
    text = " " + " ".join(words) + " "
    # where each word begins in the text: a place's word is found by bisection
    begins = list(accumulate((len(w) + 1 for w in words), initial=1))
    places, labels = [], set()
    for phrase, label in base.items():
        needle, at = f" {phrase} ", -1
        while (at := text.find(needle, at + 1)) >= 0:
            places.append(bisect_left(begins, at + 1))
            labels.add(label)
    spans, best = [], 1.0 if places else 0.0
    for label, a, b, edits, length in scanner.fuzzy(text):
        best = max(best, 1 - edits / length)
        a += text[a] == " "
        b -= text[b - 1] == " "
        spans.append((label, bisect_right(begins, a) - 1, bisect_left(begins, b), edits))
    every = labels | {s[0] for s in spans}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), best, sorted(set(spans)))


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,end_word:long,edits:int>>"


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """License phrases and fuzzy notices of every text, with their spans in words: one pass, no shuffle."""
    notices, base = dict(NOTICES if notices is None else notices), dict(BASE if base is None else base)

    def row(raw, scanner):
        out = scan(raw, scanner, base)
        return (*out[:-1], [dict(zip(("label", "first_word", "end_word", "edits"), s, strict=True)) for s in out[-1]])

    return map_rows(docs, SCHEMA, row, setup=lambda: Scanner(notices))


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    got = scan_licenses(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").cast("long").alias("n_spans"))


QUERIES = {"op5_licenses": op5_licenses}
ORACLES: dict[str, str] = {}
