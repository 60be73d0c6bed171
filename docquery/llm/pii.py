r"""Personal data: base kinds by pattern, and unseen identifiers by bootstrapped contextual extraction.

Base kinds are email, ip, card and phone, found leftmost and non-overlapping for each kind; a match that fails its
check (an ip part over 255, a card's Luhn sum or length, a phone's digits) is dropped without another try.

The method: base matches and secret-like tokens (32 hexadecimal digits or more, of both sorts) are the seed instances.
Every identifier-like token (it holds a digit, and has ``SHORTEST`` characters or more) is an instance, and so is a run of
such tokens with one space between (and a short code in capitals).  The words to the left and right are
lexical patterns, whatever the instance's shape; the left words with the shape are further, narrower patterns.  Spark
scores the graph of patterns and instances in rounds until the trusted patterns settle (``ROUNDS`` at most): a pattern's confidence is the mean score of its distinct
instances, and an instance's score is the highest confidence of a pattern that is trusted.  Every plain word (a word
without a digit, in no base match) is an instance of score 0, so that a word that stands before anything is no
pattern.  More instances of score 0 only ever lower a confidence: the rounds run without plain words first, and the
patterns that are not trusted then are not trusted with them either.  So plain words are counted, all of them, for those
that are left.  Where a task alone finds more different plain words of a pattern than any confidence has room for, the
pattern is out, as with the count of all, and is not looked for any more.  Instances that a trusted pattern finds, and no base kind covers, are spans of kind ``context``; a token in a
run that is found is part of the run's span.  Words of a pattern are looked for in the ``AROUND`` characters on either
side; one that is longer is no pattern.  Shapes of more than ``SHAPE`` characters are one with those that begin alike.

The texts are read three times and never shuffled: for the graph, for the plain words, and to find what the trusted
patterns find.  Of patterns, ``BROADCAST`` at most are broadcast; where there are more, they are joined with the plain
words, or with the instances of each text.

Spans are in code points, end exclusive.  Null and empty texts have none.  Repeated rows count once in the graph, as
instances are distinct, and are reported row by row; an empty table gives an empty result.  Further columns pass
through, and those named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Set

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw
from docquery.llm.shared import drop, stored, trimmed

KINDS = ("email", "ip", "card", "phone")
#: A pattern is trusted with this confidence and so many distinct seeds or found instances.
CONFIDENCE, SUPPORT, ROUNDS = 0.5, 3, 6
#: Shortest token that can be an identifier, characters in which a pattern's words are looked for, and of a shape.
SHORTEST, AROUND, SHAPE = 6, 64, 40
#: Trusted patterns that are broadcast.
BROADCAST = 1 << 18
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Tokens of a run: a longer one is taken in pieces.
RUN = 8
#: Pairs of a pattern and a plain word that a task tells apart before it passes them on.
PAIRS = 1 << 17
#: Confidence and support that a pattern may lack in the rounds without plain words: sums of doubles have no fixed order.
SLACK = 1e-6
_TOKEN = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*+")
_EDGE = " \t\n\r\v\f.,;:!?\"'()[]{}<>*#$%&|="
_INNER = _EDGE.replace("(", "").replace(")", "")
_BETWEEN = re.compile(r" (?:[A-Z]{1,4} )?")
_WORD, _DIGIT = re.compile(r"\S+"), re.compile(r"[0-9]")
_SHAPES = ((re.compile(r"[0-9]+"), "9"), (re.compile(r"[^\W\d_]+"), "a"))
_HEX = re.compile(r"[0-9a-f]{16,}")
_SECRET = re.compile(r"(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the run of its characters before @, back to the end of the last match: no text is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(match: str) -> bool:
    digits = [int(c) for c in match if c not in " -"]
    if not 13 <= len(digits) <= 19:
        return False
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if _luhn(m.group())]
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def shape(token: str) -> str:
    """Runs of digits and letters as one sign each; a number keeps its length, and long hex strings are one shape."""
    if token.isdigit():
        return f"9x{len(token)}"
    if _HEX.fullmatch(token):
        return "hex"
    for runs, sign in _SHAPES:
        token = runs.sub(sign, token)
    return token[:SHAPE]


def _around(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The words to the left and to the right; one that is cut off by ``AROUND`` is left out."""
    left, right = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    before, after = left.split(), right.split()
    if start > AROUND and left and not left[0].isspace() and not text[start - AROUND - 1].isspace():
        before = before[1:]
    if end + AROUND < len(text) and right and not right[-1].isspace() and not text[end + AROUND].isspace():
        after = after[:-1]
    return before, after


def _lexical(text: str, start: int, end: int) -> list[str]:
    """The one and the two words to the left, those to both sides, and the two to the right, in lower case."""
    left, right = ([x for w in part if (x := w.strip(_EDGE).lower())] for part in _around(text, start, end))
    out = ["l\t" + " ".join(left[-k:]) for k in (1, 2) if len(left) >= k]
    out += [f"b\t{left[-1]}\t{right[0]}"] if left and right else []
    return out + (["r\t" + " ".join(right[:2])] if len(right) > 1 else [])


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns, and the one and the two words to the left, each with the shape."""
    words, form = [w.lower() for w in _around(text, start, end)[0][-2:]], shape(text[start:end])
    return _lexical(text, start, end) + ["s\t" + " ".join(words[-k:]) + "\t" + form for k in range(1, len(words) + 1)]


def _runs(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Neighbours among the tokens, with no punctuation but brackets between them."""
    own: list[tuple[int, int]] = []
    for a, b in [*tokens, (len(text) + 2, len(text) + 2)]:
        joined = own and _BETWEEN.fullmatch(text, own[-1][1], a) and text[a:b].lstrip(_INNER) == text[a:b] and text[slice(*own[-1])].rstrip(_INNER) == text[slice(*own[-1])]
        if joined and len(own) < RUN:
            own.append((a, b))
            continue
        if len(own) > 1:
            run = text[own[0][0] : own[-1][1]]
            inner = run.lstrip(_INNER if ")" in run else _EDGE)
            start = own[-1][1] - len(inner)
            yield start, start + len(inner.rstrip(_EDGE))
        own = [(a, b)]


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, bool, str, list[str], bool]]:
    """(start, end, seed, instance, patterns, open) of base matches and of other identifier-like tokens and runs of them."""
    out, covered = [], sorted((a, b) for _, a, b in base)
    for a, b in covered:
        out.append((a, b, True, text[a:b], _patterns(text, a, b), False))
    k, free = 0, []
    for m in _TOKEN.finditer(text):
        token = m.group().strip(_EDGE)
        a = m.start() + m.group().index(token)
        b = a + len(token)
        while k < len(covered) and covered[k][1] <= a:
            k += 1
        if any(x < b and a < y for x, y in covered[k : k + 8]):
            continue
        free.append(m.span())
        if len(token) >= SHORTEST:
            out.append((a, b, bool(_SECRET.fullmatch(token)), token, _patterns(text, a, b), True))
    out += [(a, b, False, text[a:b], _patterns(text, a, b), True) for a, b in _runs(text, free) if b - a >= SHORTEST]
    return out


def plain_words(text: str, known: Set[str] | None = None, beside: Set[str] | None = None) -> set[tuple[str, str]]:
    """(lexical pattern, word) of every word without digits that overlaps no base match, of patterns in ``known`` if given.

    ``beside`` are the words next to the instances of known patterns.  The patterns are those of ``_lexical``.
    """
    words = [w.strip(_EDGE).lower() for w in text.split()]
    if beside is not None and not any(w in beside for w in words):
        return set()
    bounds, base, out = [m.span() for m in _WORD.finditer(text)], None, set()
    if "" in words:
        bounds, words = [b for b, w in zip(bounds, words) if w], [w for w in words if w]
    last = len(words) - 1
    near = range(len(words)) if beside is None else sorted({j for i, w in enumerate(words) if w in beside for j in (i - 1, i + 1) if 0 <= j <= last})
    for i in near:
        start, end = bounds[i]
        word = text[start:end]
        if _DIGIT.search(word):
            continue
        own = word.strip(_EDGE)
        start += word.index(own)
        end = start + len(own)
        if "@" in own or not own.strip("-.()"):
            base = base_spans(text) if base is None else base
            if any(a < end and start < b for _, a, b in base):
                continue
        patterns, left, right = [], None, None
        if i and bounds[i - 1][0] >= start - AROUND:
            left = words[i - 1]
            patterns.append("l\t" + left)
            if i > 1 and bounds[i - 2][0] >= start - AROUND:
                patterns.append(f"l\t{words[i - 2]} {left}")
        if i < last and bounds[i + 1][1] <= end + AROUND:
            right = words[i + 1]
            if left is not None:
                patterns.append(f"b\t{left}\t{right}")
            if i + 1 < last and bounds[i + 2][1] <= end + AROUND:
                patterns.append(f"r\t{right} {words[i + 2]}")
        out.update((p, own) for p in patterns if known is None or p in known)
    return out


def _beside(pattern: str) -> str:
    """The word of a lexical pattern that stands next to the instance."""
    kind, words, *_ = pattern.split("\t")
    return words.split(" ")[0 if kind == "r" else -1]


_CANDIDATE = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("seed", T.BooleanType()),
    T.StructField("instance", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType())), T.StructField("open", T.BooleanType())])
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FOUND = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("_base", T.StringType()), T.StructField("_more", _SPAN)])
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("instance", pa.string()), ("patterns", pa.list_(pa.string())), ("open", pa.bool_())]))
_ARROW_FOUND = [*[pa.int64()] * len(KINDS), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
_SIGN = re.compile(rb"[0-9@]")


def _instances(docs: DataFrame, text: str, kept: list[str]) -> DataFrame:
    """``kept`` with _candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            rows = []
            for a, b in zip(offsets, offsets[1:]):
                raw = data[a:b].tobytes()
                own = raw.decode() if _SIGN.search(raw) else ""
                rows.append([dict(zip(_CANDIDATE.names, c)) for c in (candidates(own, base_spans(own)) if own else [])])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(rows, _ARROW)], [*kept, "_candidates"])

    return docs.mapInArrow(trimmed(run), T.StructType([*[f for f in docs.schema.fields if f.name in kept], T.StructField("_candidates", T.ArrayType(_CANDIDATE))]))


def _plain(docs: DataFrame, text: str, rooms) -> DataFrame:
    """(pattern, word) of all plain words, of the broadcast patterns if there are any; pairs may repeat.

    A pattern comes with the number of plain words that it has room for.  Once a task finds more, it passes on the pattern
    with a null.  It counts slots that words fall into, which are never more than the words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = rooms.value if rooms is not None else {}
        known = set(room) if rooms is not None else None
        uses = Counter(map(_beside, room))
        beside = set(uses) if rooms is not None else None
        slots: dict[str, bytearray] = {}
        used: Counter[str] = Counter()
        pairs: defaultdict[str, set[str | None]] = defaultdict(set)
        held = 0

        def packed() -> pa.RecordBatch:
            rows = [(p, w) for p, ws in pairs.items() for w in ws]
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["pattern", "word"])

        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            for a, b in zip(offsets, offsets[1:]):
                for p, w in plain_words(data[a:b].tobytes().decode(), known, beside):
                    if known is not None:
                        if p not in known:
                            continue
                        own = slots.get(p)
                        if own is None:
                            own = slots[p] = bytearray(4 * room[p] + 64)
                        at = hash(w) % len(own)
                        if not own[at]:
                            own[at] = 1
                            used[p] += 1
                            if used[p] > room[p]:
                                known.discard(p)
                                held -= len(pairs[p]) - 1
                                pairs[p] = {None}
                                del slots[p]
                                word = _beside(p)
                                uses[word] -= 1
                                if not uses[word]:
                                    beside.discard(word)
                                continue
                    if w not in pairs[p]:
                        pairs[p].add(w)
                        held += 1
                if held >= PAIRS:
                    yield packed()
                    held = 0
        yield packed()

    return docs.select(text).mapInArrow(trimmed(run), "pattern string, word string")


def _outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without those inside another."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans), key=lambda s: (s[0], -s[1])):
        if not out or b > out[-1][1]:
            out.append((a, b))
    return out


def _spans(docs: DataFrame, text: str, kept: list[str], trusted) -> DataFrame:
    """``kept`` with the counts and spans of base kinds, and with what the broadcast patterns find, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trusted.value if trusted is not None else frozenset()
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            rows = []
            for a, b in zip(offsets, offsets[1:]):
                raw = data[a:b].tobytes()
                if not _SIGN.search(raw):
                    rows.append((0, 0, 0, 0, "", []))
                    continue
                own = raw.decode()
                base = base_spans(own)
                more = _outermost([(c[0], c[1]) for c in candidates(own, base) if c[5] and not known.isdisjoint(c[4])]) if known else []
                rows.append((*[sum(k == kind for k, _, _ in base) for kind in KINDS], ",".join(f"{k}:{s}:{e}" for k, s, e in base), [{"start": s, "end": e} for s, e in more]))
            columns = list(zip(*rows)) if rows else [()] * len(_ARROW_FOUND)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(c, t) for c, t in zip(columns, _ARROW_FOUND)]], [*kept, *_FOUND.names])

    return docs.mapInArrow(trimmed(run), T.StructType([*[f for f in docs.schema.fields if f.name in kept], *_FOUND.fields]))


def _settled(edges: DataFrame, plain: DataFrame | None, rounds: int, confidence: float, support: float) -> DataFrame:
    """(pattern, confidence, _mass, _n) of the trusted patterns, when they have settled or after ``rounds``; stored."""
    scored, patterns, state = edges.select("pattern", "instance", F.col("seed").cast("double").alias("score")), None, None
    for _ in range(rounds):
        own = scored.groupBy("pattern").agg(F.sum("score").alias("_mass"), F.count("*").alias("_n"))
        if plain is not None:
            own = own.join(plain, "pattern", "left").withColumn("_n", F.col("_n") + F.coalesce("n_plain", F.lit(0)))
        own = own.withColumn("confidence", F.col("_mass") / F.col("_n"))
        last, patterns = patterns, stored(own.where((F.col("confidence") >= confidence) & (F.col("_mass") >= support)).select("pattern", "confidence", "_mass", "_n"), "pii-patterns")
        drop(*([last] if last is not None else []))
        seen, state = state, patterns.agg(F.count("*"), F.sum(F.xxhash64("pattern", F.round("confidence", 9)).cast("decimal(38,0)"))).first()
        if state == seen:
            break
        reached = edges.join(patterns, "pattern").groupBy("instance").agg(F.max("confidence").alias("_reached"))
        scored = edges.join(reached, "instance", "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("_reached", F.lit(0.0)))).select("pattern", "instance", "score")
    return patterns


def trusted_patterns(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT, limit: int = BROADCAST) -> DataFrame:
    """(pattern, confidence) over the pattern-instance graph, when it has settled or after ``rounds``.

    Edges are distinct, so a pattern or an instance of a third of all places has one edge for each different partner.
    All steps are aggregates that combine before the exchange and equi-joins that adaptive execution can split.
    """
    places = _instances(docs, text, []).select(F.inline("_candidates")).select("seed", "instance", F.explode("patterns").alias("pattern"))
    edges = stored(places.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    # scores only rise from round to round, and fall with every plain word: no other pattern can be trusted
    likely = _settled(edges, None, rounds, confidence - SLACK, support - SLACK)
    lexical = likely.where(~F.col("pattern").startswith("s\t")).select("pattern", "_mass", "_n")
    few = confidence > SLACK and lexical.limit(limit + 1).count() <= limit
    rooms = docs.sparkSession.sparkContext.broadcast({r["pattern"]: math.floor(r["_mass"] / (confidence - SLACK)) - r["_n"] for r in lexical.toLocalIterator()}) if few else None
    pairs = _plain(docs, text, rooms)
    pairs = pairs if few else pairs.join(lexical, "pattern", "left_semi")
    plain = stored(pairs.distinct().groupBy("pattern").agg(F.count("word").alias("n_plain"), F.max(F.col("word").isNull()).alias("_out")), "pii-plain")
    narrow = stored(edges.join(likely, "pattern", "left_semi").join(plain.where("_out"), "pattern", "left_anti"), "pii-likely")
    drop(edges, likely)
    if few:
        rooms.destroy()
    patterns = _settled(narrow, plain.select("pattern", "n_plain"), rounds, confidence, support)
    drop(narrow, plain)
    return patterns


def find(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT, with_text: bool = False, limit: int = BROADCAST) -> DataFrame:
    """``docs`` without its text (unless ``with_text``) with n_email, n_ip, n_card, n_phone, n_context, base_spans and spans.

    Both span columns are ``kind:start:end`` joined by commas, by kind (``context`` last), then start.
    """
    new = {*_FOUND.names, "n_context", "base_spans", "spans", "_row"} - {text}
    docs = docs.drop(*(c for c in docs.columns if c in new))
    kept = [c for c in docs.columns if with_text or c != text]
    patterns = trusted_patterns(docs.select(text), text, rounds, confidence, support, limit)
    few = patterns.limit(limit + 1).count() <= limit
    if few:
        known = docs.sparkSession.sparkContext.broadcast(frozenset(r["pattern"] for r in patterns.toLocalIterator()))
        out = _spans(docs, text, kept, known).withColumnRenamed("_base", "base_spans")
    else:
        rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "pii-rows")
        open_ = _instances(rows.select("_row", text), text, ["_row"]).select("_row", F.inline("_candidates")).where("open").select("_row", "start", "end", F.explode("patterns").alias("pattern"))
        more = open_.join(patterns, "pattern").groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("start", (-F.col("end")).alias("_end"), "end"))).alias("_more"))
        # a run comes before its tokens, RUN at most
        inside = lambda s, k: F.exists(F.slice("_more", F.greatest(k - RUN + 1, F.lit(1)), F.least(k, F.lit(RUN))), lambda r: r["end"] >= s["end"])
        more = more.withColumn("_more", F.filter("_more", lambda s, k: ~inside(s, k)))
        out = _spans(rows, text, [*kept, "_row"], None).drop("_more").join(more, "_row", "left").drop("_row").withColumnRenamed("_base", "base_spans")
    extra = F.transform("_more", lambda s: F.concat(F.lit("context:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
    spans = F.concat_ws(",", F.when(F.col("base_spans") != "", F.col("base_spans")), F.nullif(F.array_join(extra, ","), F.lit("")))
    return out.withColumns({"spans": spans, "n_context": F.coalesce(F.size("_more"), F.lit(0)).cast("long")}).drop("_more")


def redact(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; spans that overlap become one."""
    columns = docs.columns
    packed = docs.select(text, F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{c}`") for c in columns if c != text]).alias("_kept"))
    found = find(packed, text, with_text=True, **options).select(text, F.col("spans").alias("_spans"), "_kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for k, spans in enumerate(batch.column("_spans").to_pylist()):
                if not spans:
                    continue
                own, out, at = texts[k], [], 0
                for a, b, kind in sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(","))):
                    if a >= at:
                        out += [own[at:a], f"[{kind.upper()}]"]
                    at = max(at, b)
                texts[k] = "".join(out) + own[at:]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("_kept")], [text, "_kept"])

    out = found.mapInArrow(trimmed(run), T.StructType([packed.schema[text], packed.schema["_kept"]]))
    return out.select(*[F.col(text) if c == text else F.col("_kept").getField(c).alias(c) for c in columns])
