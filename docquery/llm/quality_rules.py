r"""Quality rules: a threshold table compiled into one projection of built-in functions.

Words are ``[^\x20\x09-\x0D]+``.  A null or empty text has no words and fails the length rule.  Repeated rows are
judged row by row; an empty table gives an empty result; columns of the input other than ``text`` pass through
untouched, and an input column named like a measure is replaced by the measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the corpus's languages.
STOP_WORDS = (
    "the of and to in a is that it for on with as was at by this be from or are an not have "
    "le la les de des du et un une que qui en est pour dans pas sur par au "
    "der die das und ist von den mit zu ein eine auf im nicht für sich dem "
    "el los las del una y por con para se al su como más lo"
).split()
_SYMBOLS = "[#*$%&|<>]"
_WS = r"[\\x20\\x09-\\x0D]"


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= measure <= high``; ``measure`` is an SQL expression over the measures."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        value, bad = F.expr(self.measure), F.lit(False)
        if self.low is not None:
            bad = bad | (value < F.lit(self.low))
        if self.high is not None:
            bad = bad | (value > F.lit(self.high))
        return F.coalesce(bad, F.lit(False))


#: The base: in whole numbers, so that no rounding decides.
BASE = (Rule("n_words", "n_words", low=50), Rule("repeated_words", "100 * n_repeat_words - 50 * n_words", high=0))
#: The table of the method; ratios of a document without words are null and judge nothing.
RULES = (
    Rule("mean_word_length", "word_chars / nullif(n_words, 0)", low=2.0, high=15.0),
    Rule("symbol_ratio", "n_symbols / nullif(n_words, 0)", high=0.3),
    Rule("stop_word_ratio", "n_stop_words / nullif(n_words, 0)", low=0.02),
    Rule("duplicate_line_ratio", "n_dup_lines / nullif(n_lines, 0)", high=0.5),
)


def measures(docs: DataFrame, text: str = "text", hash_bits: int = 40, long_text: int = 1 << 24) -> DataFrame:
    """All measures beside the input columns, in three projections: no exchange, no generator.

    ``transform(array(x), y -> ...)[0]`` binds ``x`` once, as a function inside a lambda would otherwise be evaluated
    again for every element.  Windows of three words become longs: 40 bits of a hash over 24 bits of the position,
    which Spark sorts as primitives.  Neighbours that agree in the 40 bits (``_near``) are compared word by word.  Where
    any two differ, all windows of ``_near`` are sorted by their words instead, as equal ones need not be neighbours.
    A text of ``long_text`` words or more has 33 bits of the hash over 31 bits of the position.
    """
    t = f"coalesce(`{text}`, '')"
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(x for w in STOP_WORDS for x in (w, w.capitalize())))
    first, last = "if(s[0] = '', 1, 0)", "if(size(s) > 1 AND element_at(s, -1) = '', 1, 0)"
    lines = f"filter(split({t}, '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    window = "shiftleft(get(v, i), 9) ^ shiftrightunsigned(get(v, i), 55) ^ shiftleft(get(v, i + 1), 37) ^ shiftrightunsigned(get(v, i + 1), 27) ^ h"
    low, most = f"if(size(_words) < {long_text}, {(1 << 24) - 1}L, {(1 << 31) - 1}L)", (1 << (64 - hash_bits)) - 1
    packed = f"transform(array(transform(_words, w -> xxhash64(w))), v -> sort_array(transform(slice(v, 3, size(v)), (h, i) -> (({window}) & ~({low} | {most}L)) | i)))[0]"
    pairs = f"filter(arrays_zip(p, slice(p, 2, size(p))), x -> (x.p ^ x['1']) BETWEEN 0L AND {low})"
    near = f"transform(array({packed}), p -> transform({pairs}, x -> struct(cast(x.p & {low} AS int) AS i, cast(x['1'] & {low} AS int) AS j)))[0]"
    same = "x -> _words[x.i] = _words[x.j] AND _words[x.i + 1] = _words[x.j + 1] AND _words[x.i + 2] = _words[x.j + 2]"
    by_words = "sort_array(transform(array_distinct(concat(_near.i, _near.j)), i -> struct(_words[i] AS a, _words[i + 1] AS b, _words[i + 2] AS c, i AS i)))"
    equal = "x -> x.w.a = x['1'].a AND x.w.b = x['1'].b AND x.w.c = x['1'].c"
    sorted_pairs = f"transform(array({by_words}), w -> transform(filter(arrays_zip(w, slice(w, 2, size(w))), {equal}), x -> struct(x.w.i AS i, x['1'].i AS j)))[0]"
    repeated = f"""
        aggregate(
          transform(array(if(forall(_near, {same}), _near, {sorted_pairs})), f -> sort_array(array_distinct(concat(f.i, f.j))))[0],
          struct(-3 AS last, 0 AS n), (a, p) -> struct(p AS last, a.n + least(3, p - a.last) AS n), a -> a.n)"""
    out = docs.withColumns({
        # Not deterministic for the optimizer, so that no filter above is pushed below and has the words split in a lambda.
        "_words": F.expr(f"IF(monotonically_increasing_id() >= 0, transform(array(split({t}, '{_WS}+')), s -> slice(s, 1 + {first}, size(s) - {first} - {last}))[0], NULL)"),
        "_lines": F.expr(f"transform(array({lines}), l -> struct(size(l) AS n, size(array_distinct(l)) AS different))[0]"),
        "n_symbols": F.expr(f"cast(size(split({t}, '{_SYMBOLS}')) - 1 AS bigint)"),
    })
    out = out.withColumn("_near", F.expr(f"if(size(_words) < 3, cast(array() AS array<struct<i: int, j: int>>), {near})"))
    return out.withColumns({
        "n_words": F.expr("cast(size(_words) AS bigint)"),
        "word_chars": F.expr("cast(char_length(array_join(_words, '')) AS bigint)"),
        "n_lines": F.expr("cast(_lines.n AS bigint)"),
        "n_dup_lines": F.expr("cast(_lines.n - _lines.different AS bigint)"),
        "n_repeat_words": F.expr(f"cast(if(size(_near) = 0, 0, {repeated}) AS bigint)"),
        "n_stop_words": F.expr(f"cast(size(filter(_words, w -> w IN ({stop}))) AS bigint)"),
    }).drop("_words", "_lines", "_near")


def quality_rules(docs: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input with the measures, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    failed = F.filter(F.array(*[F.when(r.fails(), F.lit(r.name)) for r in (*base, *rules)]), lambda x: x.isNotNull())
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | r.fails()
    out = measures(docs, text).withColumns({"base_failed": base_failed, "failed_rules": failed})
    return out.withColumn("kept", F.size("failed_rules") == 0)
