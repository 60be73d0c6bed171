r"""Benchmark decontamination: a broadcast hash set of test n-grams against the word windows of every text.

Text is lower-cased (A-Z) and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  A window is ``n`` consecutive words
of a benchmark item; an item with fewer words, but not none, is one window.  A word inside any occurrence of a window
is hit; a document is contaminated when 5 % of its words or more are hit.

Null or empty texts have no words and are never contaminated; a null or empty item has no window; an item whose id is
null marks words but is in no list of items; repeated documents are judged row by row and repeated items count once
by id.  Empty tables give empty results, or documents without hits.  Further input columns pass through; those named
like a result column are replaced.

The benchmark is read in blocks of about ``BLOCK_CHARS`` characters, whole items, so that no broadcast is large; the
documents pass through one scan for each block, and each scan adds its hits to those before.  There is no exchange, so a
task holds all blocks: 16 bytes for each window, and the words themselves, about four times the benchmark's text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw
from docquery.llm.shared import trimmed

#: Characters of benchmark text in one broadcast.
BLOCK_CHARS = 4_000_000
_WIDE = 22


class _Grams:
    """Windows of one block: sorted hashes with the place of each in the items, and the items' words to verify hits."""

    def __init__(self, items: list[tuple[object, str | None]], n: int):
        self.items, self.words, self.starts, self.known = [], [], [], {}
        found: dict[int, list[tuple]] = {}
        for item, text in items:
            data, offsets = bw.buffers(pa.array([text or ""], pa.string()))
            starts, ends, _ = bw.word_bounds(data, offsets, bw.ALNUM)
            if not len(starts):
                continue
            size = min(n, len(starts))
            hashes = bw.window_hashes(bw.word_hashes(data, starts, ends), size)
            found.setdefault(size, []).append((hashes, np.full(len(hashes), len(self.items), np.int32), np.arange(len(hashes), dtype=np.int32)))
            words = [bytes(bw.LOWER[data[a:b]]) for a, b in zip(starts, ends)]
            self.items.append(item)
            self.words.append(b" ".join(words) + b" ")
            self.starts.append(np.cumsum([0, *[len(w) + 1 for w in words]]).astype(np.int32))
        self.hashes, self.places, self.marks = {}, {}, {}
        for size, parts in found.items():
            hashes, owner, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            self.hashes[size], self.places[size] = hashes[order], (owner[order], at[order])
            self.marks[size] = self._mark(hashes)

    def same(self, size: int, h: np.uint64, key: bytes) -> list:
        """Items that hold a window of these words, each once."""
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            a, b = (np.searchsorted(self.hashes[size], h, side) for side in ("left", "right"))
            out = {}
            for owner, at in zip(*(x[a:b].tolist() for x in self.places[size])):
                starts = self.starts[owner]
                if self.words[owner][starts[at] : starts[at + size] - 1] == key:
                    out[self.items[owner]] = None
            self.known[key] = list(out)
        return self.known[key]

    @staticmethod
    def _mark(hashes: np.ndarray) -> np.ndarray:
        """A bit map that most windows fail at once."""
        out = np.zeros(1 << _WIDE, bool)
        out[(hashes >> np.uint64(64 - _WIDE)).astype(np.int64)] = True
        return out

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """Word starts, ends, word offsets of documents, and for each verified window (document, first word, size, items)."""
        starts, ends, bounds = bw.word_bounds(data, offsets, bw.ALNUM)
        words, out = bw.word_hashes(data, starts, ends), []
        for size, table in self.hashes.items():
            all_windows = bw.window_hashes(words, size)
            maybe = np.flatnonzero(self.marks[size][(all_windows >> np.uint64(64 - _WIDE)).astype(np.int64)])
            at = np.searchsorted(table, all_windows[maybe])
            maybe = maybe[table[np.minimum(at, len(table) - 1)] == all_windows[maybe]]
            docs = np.searchsorted(bounds, maybe, "right") - 1
            inside = maybe + size <= bounds[docs + 1]
            for k, doc in zip(maybe[inside].tolist(), docs[inside].tolist()):
                key = b" ".join([bytes(bw.LOWER[data[a:b]]) for a, b in zip(starts[k : k + size], ends[k : k + size])])
                if items := self.same(size, all_windows[k], key):
                    out.append((doc, k, size, items))
        return starts, ends, bounds, out


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("clean_text", T.StringType()),
])
_STATE = T.StructType([T.StructField("_hit_words", T.ArrayType(T.LongType())), T.StructField("_hit_items", T.ArrayType(T.StringType()))])


def _scan(grams, text_column: str, kept: list[str], first: bool, last: bool, with_text: bool):
    """The function for one block: adds its hits to those carried along, and on the last block works out the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = grams.value
        for batch in batches:
            n = batch.num_rows
            data, offsets = bw.buffers(batch.column(text_column))
            hit: list[set[int]] = [set() for _ in range(n)]
            items: list[set] = [set() for _ in range(n)]
            if not first:
                hit = [set(x) for x in batch.column("_hit_words").to_pylist()]
                items = [set(x) for x in batch.column("_hit_items").to_pylist()]
            n_words, spans, clean = np.zeros(n, np.int64), [[] for _ in range(n)], [None] * n
            for i, j, part, own in bw.runs(data, offsets):
                starts, ends, bounds, found = table.hits(part, own)
                n_words[i:j] = np.diff(bounds)
                for doc, k, size, ids in found:
                    hit[i + doc].update(range(k - int(bounds[doc]), k - int(bounds[doc]) + size))
                    items[i + doc].update(str(x) for x in ids if x is not None)
                if last:
                    for d in (d for d in range(i, j) if hit[d]):
                        spans[d], clean[d] = _cut(part, own, starts, ends, int(bounds[d - i]), d - i, sorted(hit[d]))
            columns = [batch.column(c) for c in kept]
            if last:
                columns += [pa.array(n_words), pa.array([len(x) for x in hit], pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                            pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                if with_text:
                    texts = batch.column(text_column)
                    columns.append(pa.array([texts[d].as_py() if clean[d] is None else clean[d] for d in range(n)], pa.string()))
                names = kept + RESULT.names[: 4 + with_text]
            else:
                columns += [pa.array([sorted(x) for x in hit], pa.list_(pa.int64())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                names = kept + _STATE.names
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _cut(data, offsets, starts, ends, base: int, doc: int, words: list[int]) -> tuple[list[tuple[int, int]], str]:
    """Runs of hit words as code-point spans, and the text without them."""
    begin, end = int(offsets[doc]), int(offsets[doc + 1])
    raw, out, rest, at = data[begin:end].tobytes(), [], [], 0
    runs = np.split(np.array(words), np.flatnonzero(np.diff(words) != 1) + 1)
    done = points = 0
    for run in runs:
        a, b = int(starts[base + run[0]]) - begin, int(ends[base + run[-1]]) - begin
        points += len(raw[done:a].decode())
        length = len(raw[a:b].decode())
        out.append((points, points + length))
        rest.append(raw[at:a])
        points, done, at = points + length, b, b
    rest.append(raw[at:])
    return out, b"".join(rest).decode()


def _blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_chars`` characters, dealt by hash; the size is checked first."""
    total = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    count = -(-total // block_chars) or 1
    if count == 1:
        return [benchmark]
    return [benchmark.where(F.pmod(F.xxhash64(item, text), F.lit(count)) == k) for k in range(count)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text", item: str = "item_id", item_text: str = "text",
                  with_text: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (as strings, sorted), hit_spans (code points) and contaminated.

    ``with_text`` adds clean_text, the text without its hit words.
    """
    spark = docs.sparkSession
    docs = docs.drop(*(set(docs.columns) & {*RESULT.names, *_STATE.names, "contaminated"} - {text}))
    kept = docs.columns
    parts = _blocks(benchmark.select(item, item_text), item, item_text, block_chars)
    for k, part in enumerate(parts):
        rows = [(r[0], r[1]) for r in part.toLocalIterator()]
        grams, last = spark.sparkContext.broadcast(_Grams(rows, n)), k == len(parts) - 1
        schema = T.StructType([*docs.schema.fields[: len(kept)], *(RESULT.fields[: 4 + with_text] if last else _STATE.fields)])
        docs = docs.mapInArrow(trimmed(_scan(grams, text, kept, k == 0, last, with_text)), schema)
    return docs.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))

