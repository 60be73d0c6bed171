r"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text.  A text is parsed greedily
against each automaton: a phrase is the longest match from where the last one ended.  The language that needs the
fewest normalised phrases wins.  Normalised is by the sample, as a longer one has longer matches: c phrases of a text of
n bytes, each named by its place among m bytes of a sample, make ``c log2(m) / n`` bits a byte, the cross-parsing entropy.

Texts are lower-cased (A-Z), as UTF-8 bytes; runs of characters that are not letters count as one space.  They are
parsed in blocks of ``BLOCK`` bytes, all bytes of all blocks, so that many blocks advance in step in numpy.

Null texts and texts without a letter give ``und`` and score 0.  A tie goes to the language that sorts first.
Repeated rows are judged row by row, and an empty table gives an empty result.  Without any labelled text every text
is ``und``.  Every language with a labelled text that has a letter is learned.  The sample is ``SAMPLE_ROWS`` rows of
each language at most, those with the smallest hash in each of as many buckets, and whole rows are taken until
``SAMPLE_BYTES`` are reached.  Texts of more than ``SAMPLE_BYTES`` characters are taken only where a language has no
shorter one, and then cut to ``SAMPLE_BYTES`` in all.  Where the automata of all languages would take more than
``TABLE_BYTES``, texts are parsed a chunk at a time against one block of languages after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw

#: Bounds of the fitted sample, for each language.
SAMPLE_ROWS, SAMPLE_BYTES = 128, 60_000
#: Bytes of automata that a worker holds at once, and bytes of text that it parses against each of several blocks.
TABLE_BYTES, CHUNK_BYTES = 1 << 29, 1 << 25
BLOCK = 256
_LETTER = np.array([b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state; state 0 is the root, and every substring is a path from it."""
    links, lengths, steps, last = [-1], [0], [{}], 0
    for c in symbols:
        new = len(steps)
        steps.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = links[p]
        if p >= 0:
            q = steps[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                copy = len(steps)
                steps.append(dict(steps[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = links[p]
                links[q] = links[new] = copy
        last = new
    return steps


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with each run of non-letters as one space, and the offsets of the texts in them."""
    letter = _LETTER[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    keep[firsts] = letter[firsts]
    out = np.where(letter, bw.LOWER[data], 32).astype(np.uint8)[keep]
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=counts[1:])
    return out, counts[offsets]


class Parser:
    """The automata of all languages as tables: for a state and a symbol, the next state, and whether a phrase ended.

    An entry is ``(row of the next state) * 2 + ended``; where a state has no transition, the entry is the root's own
    transition, with a phrase ended.  A symbol that the sample lacks ends a phrase and goes back to the root.
    """

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        self.bits = np.log2([max(len(samples[x]), 2) for x in self.languages])
        used = sorted({b for s in samples.values() for b in s})
        self.codes = np.zeros(256, np.uint8)
        self.codes[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        self.tables = []
        for lang in self.languages:
            steps = suffix_automaton(self.codes[np.frombuffer(samples[lang], np.uint8)].tolist())
            table = np.full((len(steps), width), -1, np.int64)
            for state, to in enumerate(steps):
                table[state, list(to)] = list(to.values())
            root = np.where(table[0] < 0, 0, table[0])
            table = np.where(table < 0, root * width * 2 + 1, table * width * 2).astype(np.int32)
            self.tables.append(table.ravel())

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) by each language (columns)."""
        sizes = np.diff(offsets)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = offsets[:-1][owner] + nth * BLOCK
        length = np.minimum(BLOCK, offsets[1:][owner] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order], length[order], owner[order]
        active = len(begin) - np.searchsorted(length[::-1], np.arange(1, BLOCK + 1))
        codes = self.codes[data].astype(np.int32)
        out = np.zeros((len(sizes), len(self.languages)), np.int64)
        for k, table in enumerate(self.tables):
            state, count = np.zeros(len(begin), np.int32), np.zeros(len(begin), np.int32)
            for step in range(BLOCK):
                a = active[step]
                if not a:
                    break
                got = table[state[:a] + codes[begin[:a] + step]]
                count[:a] += got & 1
                state[:a] = got >> 1
            out[:, k] = np.bincount(owner, count + 1, minlength=len(sizes)).astype(np.int64)
        return out


def language_blocks(samples: dict[str, bytes], size: int) -> list[list[str]]:
    """Languages in order, in blocks whose tables take ``size`` bytes at most (or of one language)."""
    width, out, left = len({b for s in samples.values() for b in s}) + 1, [], 0
    for lang in sorted(samples):
        own = 8 * (len(samples[lang]) + 1) * width  # two states a byte at most, four bytes an entry
        if not out or own > left:
            out.append([])
            left = size
        out[-1].append(lang)
        left -= own
    return out


_parsers: dict[tuple[str, int], Parser] = {}
_blocks: dict[tuple[str, int], list[list[str]]] = {}


def _parser(samples, block: list[str], key: tuple[str, int]) -> Parser:
    """The block built last in each Python worker, from the broadcast sample: a single block is built once."""
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser({k: samples.value[k] for k in block})
    return _parsers[key]


class _Sample:
    def __init__(self, broadcast, key: str):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self) -> dict[str, bytes]:
        return self.broadcast.value


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def _chunks(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[list[pa.RecordBatch]]:
    own, n = [], 0
    for batch in batches:
        own.append(batch)
        n += batch.column(text).nbytes
        if n >= size:
            yield own
            own, n = [], 0
    if own:
        yield own


def _lettered(part: np.ndarray, own: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    ascii_letters = np.zeros(len(part) + 1, np.int64)
    np.cumsum(_LETTER[part] & (part < 0x80), out=ascii_letters[1:])
    out = np.diff(ascii_letters[own]) > 0
    for d in np.flatnonzero(~out & (np.diff(at) > 0)):
        out[d] = any(ch.isalpha() for ch in part[own[d] : own[d + 1]].tobytes().decode())
    return out


def _predict(sample: _Sample, text: str, kept: list[str], table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (sample.id, table_bytes)
        if key not in _blocks:
            _blocks.clear()
            _blocks[key] = language_blocks(sample.value, table_bytes)
        blocks = _blocks[key]
        for chunk in _chunks(batches, text, CHUNK_BYTES if len(blocks) > 1 else 0):
            least = [np.full(b.num_rows, np.inf) for b in chunk]
            shares, has = [np.zeros(b.num_rows) for b in chunk], [np.zeros(b.num_rows, bool) for b in chunk]
            langs = [["und"] * b.num_rows for b in chunk]
            for k, block in enumerate(blocks):
                parser = _parser(sample, block, (f"{sample.id} {table_bytes}", k))
                for n, batch in enumerate(chunk):
                    data, offsets = bw.buffers(batch.column(text))
                    for i, j, part, own in bw.runs(data, offsets, 1 << 21):
                        clean, at = spaced(part, own)
                        counts = parser.phrases(clean, at) * parser.bits / np.maximum(np.diff(at), 1)[:, None]
                        if k == 0:
                            has[n][i:j] = _lettered(part, own, at)
                        shares[n][i:j] += (1.0 / np.maximum(counts, 1e-9)).sum(axis=1)
                        best = counts.argmin(axis=1)
                        fewest = counts[np.arange(j - i), best]
                        for d in np.flatnonzero(has[n][i:j] & (fewest < least[n][i:j])):
                            langs[n][i + d] = parser.languages[best[d]]
                        least[n][i:j] = np.minimum(least[n][i:j], fewest)
            for n, batch in enumerate(chunk):
                scores = np.where(has[n], 1.0 / np.maximum(least[n], 1e-9) / np.where(has[n], shares[n], 1.0), 0.0)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(langs[n], pa.string()), pa.array(scores)], [*kept, *RESULT.names])

    return run


def language_samples(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """Letters of a bounded sample of labelled texts of each language.

    One row of each of ``rows`` hash buckets is taken, that of the smallest hash: an aggregate that Spark combines
    before the exchange, so that a language with most of the rows makes no large task.
    """
    lettered = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"[^\x00-@\[-`{-\x7f]"))
    hashed = lettered.select(lang, text, F.xxhash64(text).alias("_h"), (F.length(text) > size).alias("_long"))
    picked = hashed.groupBy(lang, "_long", F.pmod("_h", F.lit(rows)).alias("_b")).agg(F.min("_h").alias("_h"))
    kinds = picked.groupBy(lang).agg(F.min("_long").alias("_long"))  # long texts only where there are no others
    picked = picked.join(F.broadcast(kinds), [lang, "_long"])
    chosen = hashed.join(F.broadcast(picked.select(lang, "_long", "_h")), [lang, "_long", "_h"]).dropDuplicates([lang, "_h"])
    letters = F.substring(F.regexp_replace(text, r"[\x00-@\[-`{-\x7f]+", " "), 1, size)
    chosen = chosen.select(lang, "_h", "_long", F.when(F.col("_long"), letters).otherwise(F.col(text)).alias(text))
    out: dict[str, bytearray] = {}
    for r in chosen.orderBy(lang, "_h").toLocalIterator():
        data, offsets = bw.buffers(pa.array([r[text]]))
        clean = spaced(data, offsets)[0].tobytes()
        own = out.setdefault(r[lang], bytearray())
        if r["_long"]:
            clean = clean[: max(0, size - len(own))].decode(errors="ignore").encode()
        if clean and (len(own) + len(clean) <= size or not own):
            own += clean + b" "
    return {k: bytes(v) for k, v in out.items()}


def identify(docs: DataFrame, samples: dict[str, bytes], text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with lang_pred and score: the winner's share of the inverse entropies."""
    docs = docs.drop(*(c for c in RESULT.names if c in docs.columns))
    sample = _Sample(docs.sparkSession.sparkContext.broadcast(samples), f"{hash(tuple(sorted(samples.items())))}")
    return docs.mapInArrow(_predict(sample, text, docs.columns, table_bytes), T.StructType([*docs.schema.fields, *RESULT.fields]))


def remainder(column: str, n: int) -> Column:
    """crc32 of a column as text modulo n; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n
