"""Search-index definitions, and their analyzers as Column expressions.

A definition is metadata; ``Analyzer.tokens`` is what its text fields would be cut into, with built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = Callable[[Column], Column]
# Kinds of fields that an index can map.
KINDS = ("autocomplete", "boolean", "date", "embeddedDocuments", "document", "geo", "number", "objectId", "string", "token", "uuid")


def _kept(c: Column) -> Column:
    return F.filter(c, lambda x: x != "")


# -- character filters: text to text


def html_strip(keep: tuple[str, ...] = ()) -> Step:
    tag = r"<(?!/?(?:%s)\b)[^>]*>" % "|".join(keep) if keep else r"<[^>]*>"
    return lambda c: F.regexp_replace(c, tag, " ")


def mapping(pairs: dict[str, str]) -> Step:
    def run(c: Column) -> Column:
        for old, new in pairs.items():
            c = F.replace(c, F.lit(old), F.lit(new))
        return c

    return run


def persian() -> Step:
    return lambda c: F.replace(c, F.lit("‌"), F.lit(" "))


# -- tokenizers: text to array


def whitespace() -> Step:
    return lambda c: _kept(F.split(c, r"\s+"))


def standard() -> Step:
    return lambda c: F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+(?:['’][\p{L}]+)*"), F.lit(0))


def keyword() -> Step:
    return lambda c: F.array(c)


def regex_split(pattern: str) -> Step:
    return lambda c: _kept(F.split(c, pattern))


def regex_capture(pattern: str, group: int = 0) -> Step:
    return lambda c: F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def url_email() -> Step:
    return lambda c: F.regexp_extract_all(c, F.lit(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|https?://\S+|[\p{L}\p{N}_]+"), F.lit(0))


def _grams(c: Column, low: int, high: int, edge: bool) -> Column:
    def at(n: int) -> Column:
        if edge:
            return F.when(F.length(c) >= n, F.array(F.substring(c, 1, n))).otherwise(F.array().cast("array<string>"))
        starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(c, i, F.lit(n)))

    return F.concat(*[at(n) for n in range(low, high + 1)])


def ngram(low: int, high: int) -> Step:
    return lambda c: _grams(c, low, high, edge=False)


def edge_gram(low: int, high: int) -> Step:
    return lambda c: _grams(c, low, high, edge=True)


# -- token filters: array to array


def lowercase() -> Step:
    return lambda c: F.transform(c, F.lower)


def trim() -> Step:
    return lambda c: F.transform(c, F.trim)


def length_filter(low: int = 0, high: int = 255) -> Step:
    return lambda c: F.filter(c, lambda x: F.length(x).between(low, high))


def stop_words(words, ignore_case: bool = True) -> Step:
    words = [w.lower() for w in words] if ignore_case else list(words)
    return lambda c: F.filter(c, lambda x: ~(F.lower(x) if ignore_case else x).isin(words))


def reverse() -> Step:
    return lambda c: F.transform(c, F.reverse)


def regex_filter(pattern: str, replacement: str, first: bool = False) -> Step:
    return lambda c: F.transform(c, lambda x: F.regexp_replace(x, f"^(.*?)(?:{pattern})" if first else pattern, f"$1{replacement}" if first else replacement))


def english_possessive() -> Step:
    return lambda c: F.transform(c, lambda x: F.regexp_replace(x, "['’][sS]$", ""))


def remove_duplicates() -> Step:
    return F.array_distinct


def shingles(low: int = 2, high: int = 2) -> Step:
    def run(c: Column) -> Column:
        def at(n: int) -> Column:
            starts = F.when(F.size(c) >= n, F.sequence(F.lit(1), F.size(c) - n + 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.array_join(F.slice(c, i, F.lit(n)), " "))

        return F.concat(*[at(n) for n in range(low, high + 1)])

    return run


def token_grams(low: int, high: int, edge: bool = False) -> Step:
    return lambda c: F.flatten(F.transform(c, lambda x: _grams(x, low, high, edge)))


def soundex() -> Step:
    return lambda c: F.transform(c, F.soundex)


def keyword_repeat() -> Step:
    return lambda c: F.flatten(F.transform(c, lambda x: F.array(x, x)))


def word_delimiter() -> Step:
    return lambda c: F.flatten(F.transform(c, lambda x: F.regexp_extract_all(x, F.lit(r"\p{Lu}?\p{Ll}+|\p{Lu}+(?!\p{Ll})|\p{N}+"), F.lit(0))))


def ascii_folding() -> Step:
    """Accented Latin letters without their marks."""
    marked, plain = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
    return lambda c: F.transform(c, lambda x: F.translate(x, marked, plain))


@dataclass(frozen=True)
class Analyzer:
    name: str
    tokenizer: Step = field(default_factory=standard)
    char_filters: tuple[Step, ...] = ()
    token_filters: tuple[Step, ...] = ()

    def tokens(self, text: Column) -> Column:
        """Null for a null text."""
        c = text
        for f in self.char_filters:
            c = f(c)
        c = self.tokenizer(c)
        for f in self.token_filters:
            c = f(c)
        return c


@dataclass(frozen=True)
class Field:
    path: str
    kind: str
    analyzer: str | None = None
    options: tuple[tuple[str, object], ...] = ()


@dataclass
class SearchIndex:
    """Definition of a text index: mapped fields, analyzers, synonyms and stored source."""

    name: str
    dynamic: bool = False
    fields: list[Field] = field(default_factory=list)
    analyzers: dict[str, Analyzer] = field(default_factory=dict)
    synonyms: dict[str, str] = field(default_factory=dict)
    stored: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    partitions: int = 1

    def map(self, path: str, kind: str, analyzer: str | None = None, **options) -> SearchIndex:
        if kind not in KINDS:
            raise ValueError(f"unknown kind of field {kind}")
        self.fields.append(Field(path, kind, analyzer, tuple(options.items())))
        return self

    def analyze(self, analyzer: Analyzer) -> SearchIndex:
        self.analyzers[analyzer.name] = analyzer
        return self

    def definition(self) -> dict:
        """Plain data, for a catalog."""
        return {
            "name": self.name, "mappings": {"dynamic": self.dynamic, "fields": {f.path: {"type": f.kind, **({"analyzer": f.analyzer} if f.analyzer else {}), **dict(f.options)} for f in self.fields}},
            "analyzers": sorted(self.analyzers), "synonyms": dict(self.synonyms), "storedSource": {"include": list(self.stored), "exclude": list(self.excluded)}, "numPartitions": self.partitions}

    def tokens(self, path: str) -> Column:
        own = next(f for f in self.fields if f.path == path)
        analyzer = self.analyzers.get(own.analyzer) if own.analyzer else Analyzer("standard", token_filters=(lowercase(),))
        return analyzer.tokens(F.col(path))
