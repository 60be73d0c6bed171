r"""License scan: fuzzy search for short notices.

Text is lower-cased (A-Z), cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` and joined by single spaces.  A notice
that may differ by k edits is split into k + 1 pieces: by the pigeonhole principle one piece stands in the text
unchanged.  Exact search for the pieces gives candidates; in the window around each the ``regex`` library's
bounded-error matching verifies the edits and gives the span, which begins and ends at word borders: where a match does
not, the whole words about it must match within the edits.

``BASE`` phrases are looked for word by word without errors, and every place counts.  Null or empty texts have no
words, no labels and score 0.  Repeated rows are scanned row by row; an empty table gives an empty result; further
columns pass through, and those named like a result column are replaced.
"""

from __future__ import annotations

import bisect
import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docquery.llm import bytewords as bw

# Phrases of the base and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Short notices of public licenses, as words, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2", "apache-2"),
    ("apache license version 2", "apache-2"),
    ("attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution", "cc-by"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("all rights reserved", "all-rights-reserved"),
    ("the software is provided as is without warranty of any kind", "mit"),
    ("neither the name of the copyright holder nor the names of its contributors", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("dedicated to the public domain", "public-domain"),
    ("eclipse public license", "epl"),
    ("european union public licence", "eupl"),
    ("boost software license", "bsl"),
    ("artistic license", "artistic"),
    ("attribution sharealike", "cc-by-sa"),
    ("attribution noderivatives", "cc-by-nd"),
)
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 10
_WORDS = bytes(int(bw.LOWER[b]) if bw.ALNUM[b] else 0x20 for b in range(256))


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    edits: int
    pieces: tuple[tuple[int, str], ...] = field(init=False)
    pattern: object = field(init=False)

    def __post_init__(self):
        n, k = len(self.phrase), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        object.__setattr__(self, "pieces", tuple((a, self.phrase[a:b]) for a, b in zip(cuts, cuts[1:])))
        object.__setattr__(self, "pattern", regex.compile(rf"(?b)(?:{regex.escape(self.phrase)}){{e<={self.edits}}}"))

    def windows(self, text: str) -> list[tuple[int, int]]:
        """Merged ranges in which an exact piece leaves room for a match."""
        found = []
        for offset, piece in self.pieces:
            at = text.find(piece)
            while at >= 0:
                found.append((max(0, at - offset - self.edits), at - offset + len(self.phrase) + self.edits))
                at = text.find(piece, at + 1)
        out: list[list[int]] = []
        for a, b in sorted(found):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [(a, b) for a, b in out]

    def _verified(self, text: str, a: int, b: int) -> Iterator:
        """The best match of the range first, then those of the parts before and behind it."""
        parts = [(a, b)]
        while parts:
            a, b = parts.pop()
            m = self.pattern.search(text, a, b) if b - a >= len(self.phrase) - self.edits else None
            if m:
                yield m
                parts += [(a, m.start()), (m.end(), b)]

    def _bordered(self, text: str, start: int, end: int) -> tuple[int, int, int] | None:
        """The least edits among the spans of whole words about a match: each side goes out or in to a word border."""
        starts = {text.rfind(" ", 0, start) + 1, start if text[start : start + 1] != " " and (start == 0 or text[start - 1] == " ") else text.find(" ", start) + 1 or end}
        ends = {text.find(" ", end) if text.find(" ", end) >= 0 else len(text), end if end == len(text) or text[end] == " " else text.rfind(" ", 0, end)}
        found = [(sum(m.fuzzy_counts), a - b, a, b) for a in starts for b in ends if a < b and (m := self.pattern.fullmatch(text, a, b))]
        return (found := min(found))[2:] + found[:1] if found else None

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of verified matches that begin and end at word borders."""
        for a, b in self.windows(text):
            for m in self._verified(text, a, min(b, len(text))):
                start, end = m.span()
                start += len(m.group()) - len(m.group().lstrip(" "))
                end -= len(m.group()) - len(m.group().rstrip(" "))
                whole = self._bordered(text, start, end) if end > start else None
                if whole and whole[2] <= self.edits:
                    yield whole


def compiled(notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> list[Notice]:
    return [Notice(phrase, label, len(phrase) // chars_per_edit) for phrase, label in notices]


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("notices", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()), T.StructField("edits", T.LongType())]))),
])
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
          pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64())]))]


def scan_text(raw: bytes, notices: list[Notice], seeds: list[bytes], base=BASE) -> tuple:
    """One text's row of ``RESULT``."""
    words = raw.translate(_WORDS).split()
    joined = b" ".join(words)
    places, base_labels, framed = [], set(), b" %b " % joined
    begins = functools.cache(lambda: list(itertools.accumulate((len(w) + 1 for w in words), initial=1)))
    for phrase, label in base:
        needle = b" %b " % phrase.encode()
        at = framed.find(needle)
        while at >= 0:
            places.append(bisect.bisect_left(begins(), at + 1))
            base_labels.add(label)
            at = framed.find(needle, at + 1)
    spans = []
    if any(s in joined for s in seeds):
        text = joined.decode()
        firsts = list(itertools.accumulate((len(w) + 1 for w in text.split(" ")), initial=0)) if words else [0]
        for notice in notices:
            for start, end, edits in notice.matches(text):
                spans.append((notice.label, bisect.bisect_right(firsts, start) - 1, bisect.bisect_left(firsts, end) - 1, edits, 1 - edits / len(notice.phrase)))
    labels = base_labels | {s[0] for s in spans}
    score = 1.0 if places else max((s[4] for s in spans), default=0.0)
    found = sorted({s[:4] for s in spans}, key=lambda s: (s[1], s[2], s[0], s[3]))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
            [dict(zip(("label", "first_word", "last_word", "edits"), s)) for s in found])


def scan(docs: DataFrame, text: str = "text", base=BASE, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """``docs`` with the columns of ``RESULT``; notices holds each verified match with its words and edits."""
    docs = docs.drop(*(c for c in RESULT.names if c in docs.columns))
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compiled(notices, chars_per_edit)
        seeds = sorted({piece.encode() for n in own for _, piece in n.pieces})
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            rows = [scan_text(data[a:b].tobytes(), own, seeds, base) for a, b in zip(offsets, offsets[1:])]
            columns = list(zip(*rows)) if rows else [()] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(c, t) for c, t in zip(columns, _ARROW)]], [*kept, *RESULT.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *RESULT.fields]))
