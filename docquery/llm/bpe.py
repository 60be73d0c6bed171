r"""Byte-level BPE: encoding of whole texts by a rank file, and decoding.

Text is cut by the tokenizer's pattern, and each piece is encoded on its own: its bytes are merged pair by pair, the
pair of the lowest rank first and of equal ranks the leftmost, until no pair has a rank.

* ``encode_words`` folds the ranked merges with Spark higher-order functions over the byte arrays of distinct words.
  The rank map is a literal: an array of small maps by hash, since Spark searches a map from end to end.
* ``encode`` counts the distinct words of the corpus and has ``encode_words`` fold them, each once: all that some task
  meets twice or more, or, where those are more than ``CACHE_WORDS``, all that stand so often that they are not.  The table of
  their ids is packed (96 bits of hashes, a place and the ids: about 35 bytes a word), so it is bounded and broadcast, and each
  word of each text is looked up in it.  A word that no task meets twice is merged where it stands, as its ids are needed
  there only: by ``_Merges``, the same merges in numpy, many words at a time, or by ``fold``, a heap, if it is long.
  No text is shuffled.
* ``decode`` concatenates the binary pieces of the ids.

A null text is an empty one; an empty text has no ids.  Repeated rows are encoded row by row; an empty table gives an
empty result; further columns pass through, and one named like the result is replaced.  Words over ``LONG_WORD``
bytes go through the heap, as a fold over arrays takes steps in the square of a word's length.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw
from docquery.llm.shared import drop, release, stored, trimmed

#: Words in the broadcast table; words a task counts, and remembers, before it starts anew; bytes of a word that is folded.
CACHE_WORDS, COUNTED, REMEMBERED, LONG_WORD = 1 << 21, 1 << 19, 1 << 18, 256
#: Bytes of a word that needs no heap.
_SHORT = 32
#: Words that are merged at once have so many bytes at most, and are so many at most.
_WIDTHS, _AT_ONCE = (4, 6, 8, 10, 12, 16, 24, 48), 1 << 13
_BUCKETS = 1 << 13
_NONE = 2147483647


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes, a space, the rank.  Its size is the vocabulary's, whatever the corpus."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the pieces of one word; a heap finds the lowest pair, the leftmost first, and a scan in a short word."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= _SHORT:
        pieces, get = [word[i : i + 1] for i in range(n)], ranks.get
        pairs = [get(word[i : i + 2], _NONE) for i in range(n - 1)]
        while pairs and (least := min(pairs)) < _NONE:
            i = pairs.index(least)
            pieces[i] += pieces.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(pieces[i] + pieces[i + 1], _NONE)
            if i:
                pairs[i - 1] = get(pieces[i - 1] + pieces[i], _NONE)
        return [ranks[p] for p in pieces]
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by start of the piece
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] != stop:
            continue
        end[i], alive[j] = stop, False
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (k := before[i]) >= 0 and (r := ranks.get(word[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _bucket(key: str) -> int:
    """Bucket of a piece in hex digits, as ``_rank`` computes it in Spark."""
    return zlib.crc32(key.encode()) % _BUCKETS


def _rank(key: str) -> str:
    return f"coalesce(try_element_at(get(m, cast(crc32(cast({key} AS binary)) % {_BUCKETS} AS int)), {key}), {_NONE})"


def encode_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """``words`` with ids: array<int>, by a fold of higher-order functions.

    The state is the pieces as hex digits and the rank of each with its right neighbour.  A step merges the leftmost
    pair of the lowest rank and looks up the two pairs that it makes; a state without a rank stays as it is.
    """
    buckets: list[dict[str, int]] = [{} for _ in range(_BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        buckets[_bucket(key)][key] = rank
    literal = f"from_json('{json.dumps(buckets, separators=(',', ':'))}', 'array<map<string,int>>')"
    step = f"""
      (s, _k) -> transform(array(coalesce(array_min(s.r), {_NONE})), least -> IF(least = {_NONE}, s,
        transform(array(cast(array_position(s.r, least) AS int)), i ->
          transform(array(concat(s.p[i - 1], s.p[i])), x -> struct(
            concat(slice(s.p, 1, i - 1), array(x), slice(s.p, i + 2, size(s.p))) AS p,
            concat(slice(s.r, 1, greatest(0, i - 2)),
              IF(i > 1, transform(array(concat(get(s.p, i - 2), x)), y -> {_rank('y')}), cast(array() AS array<int>)),
              IF(i < size(s.r), transform(array(concat(x, get(s.p, i + 1))), y -> {_rank('y')}), cast(array() AS array<int>)),
              slice(s.r, i + 2, size(s.r))) AS r))[0])[0]))[0]"""
    start = f"""transform(array(transform(sequence(0, cast(length(h) / 2 AS int) - 1), i -> substring(h, cast(2 * i + 1 AS int), 2))), p ->
        struct(p AS p, IF(size(p) < 2, cast(array() AS array<int>), transform(sequence(1, size(p) - 1), i -> transform(array(concat(p[i - 1], p[i])), y -> {_rank('y')})[0])) AS r))[0]"""
    folded = f"aggregate(IF(length(h) < 4, cast(array() AS array<int>), sequence(2, cast(length(h) / 2 AS int))), {start}, {step}, s -> transform(s.p, y -> {_rank('y')}))"
    ids = f"transform(array({literal}), m -> transform(array(hex(encode(`{word}`, 'UTF-8'))), h -> IF(h = '', cast(array() AS array<int>), IF({_rank('h')} < {_NONE}, array({_rank('h')}), {folded})))[0])[0]"
    return words.withColumn("ids", F.expr(ids))


def decode_ids(ids: str, ranks: dict[bytes, int]) -> Column:
    """The bytes of a column of ids: its pieces, from a literal array by id, concatenated.  An unknown id fails."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = f"split('{','.join(pieces)}', ',')"
    return F.expr(f"unhex(array_join(transform(`{ids}`, i -> {literal}[i]), ''))")


def _count_words(pattern: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = regex.compile(pattern), Counter()

        def out():
            short = {w: n for w, n in counts.items() if n > 1 and (len(w) <= LONG_WORD // 4 or len(w.encode()) <= LONG_WORD)}
            return pa.RecordBatch.from_arrays([pa.array(short, pa.string()), pa.array(short.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            for a, b in zip(offsets, offsets[1:]):
                counts.update(words.findall(data[a:b].tobytes().decode()))
                if len(counts) > COUNTED:
                    yield out()
                    counts.clear()
        yield out()

    return run


def repeated_words(docs: DataFrame, pattern: str, text: str = "text", limit: int = CACHE_WORDS) -> DataFrame:
    """(word, n) of the words that some task meets twice or more: all, or those above the least count that leaves at most ``limit``."""
    counted = docs.select(text).mapInArrow(trimmed(_count_words(pattern, text)), "word string, n long")
    words = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")
    left, least = 0, 1
    # words by the power of two of their count: 63 rows at most
    for r in words.groupBy(F.expr("length(bin(n)) - 1").alias("power")).count().orderBy(F.desc("power")).collect():
        left += r["count"]
        if left > limit:
            least = 2 << r["power"]
            break
    out = words.where(F.col("n") >= least)
    out._stored_at = words._stored_at
    return out


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word to find it by, and another to tell words apart that share the first."""
    words = list(map(str.encode, words))
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])
    return bw.word_hashes(data, ends[:-1], ends[1:], lower=False), np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table's part of one task: both hashes of words, numbers of their ids, and the ids."""
    for batch in batches:
        ids = batch.column("ids")
        sizes, flat = np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy()
        own = (*_hashes(batch.column("word").to_pylist()), sizes.astype(np.int32), flat.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in own], ["hashes", "checks", "sizes", "ids"])


class _Table:
    """Ids of the folded words, by the hash of the word."""

    def __init__(self, parts: list[tuple[bytes, ...]]):
        kinds = (np.uint64, np.uint32, np.int32, np.int32)
        hashes, checks, sizes, ids = (np.concatenate([np.zeros(0, t), *[np.frombuffer(p[k], t) for p in parts]]) for k, t in enumerate(kinds))
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.checks, self.starts, self.sizes, self.ids = hashes[order], checks[order], starts[order], sizes[order], ids.tobytes()

    def look_up(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The words that are in the table, with their ids."""
        if not len(self.hashes):
            return
        found, checks = _hashes(words)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[at] == found) & (self.checks[at] == checks))
        at = at[hit]
        for k, a, n in zip(hit.tolist(), (4 * self.starts[at]).tolist(), (4 * self.sizes[at]).tolist()):
            yield words[k], self.ids[a : a + n]


class _Merges:
    """The merges of ``fold`` for many words at once: a step merges one pair of each word that has one left.

    Pieces are named by their rank, and bytes that have none by numbers above all ranks, so that a pair is one number.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.top = max(ranks.values(), default=-1)
        names = {bytes([b]): self.top + 1 + b for b in range(256)} | ranks
        pairs = {names[p[:i]] << 32 | names[p[i:]]: r for p, r in ranks.items() for i in range(1, len(p)) if p[:i] in names and p[i:] in names}
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.bytes = np.array([names[bytes([b])] for b in range(256)], np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; a piece that is not there is -1."""
        if not len(self.keys):
            return np.full(left.shape, _NONE, np.int32)
        wanted = np.where(right < 0, -1, left << 32 | right)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def _same_size(self, words: list[bytes], width: int) -> list[bytes]:
        """Packed ids of words of ``width`` bytes at most."""
        out, at, sizes = [b""] * len(words), np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words))
        pieces = self.bytes[np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)]
        pieces[np.arange(width) >= sizes[:, None]] = -1
        pairs = self.look_up(pieces[:, :-1], pieces[:, 1:])
        while len(at):
            rows = np.arange(len(at))
            i = pairs.argmin(1) if pairs.shape[1] else np.zeros(len(at), np.int64)
            least = pairs[rows, i] if pairs.shape[1] else np.full(len(at), _NONE, np.int32)
            done = np.flatnonzero(least == _NONE)
            if len(done):
                if (pieces[done] > self.top).any():
                    raise KeyError("a byte without a rank")
                packed, width = pieces[done].astype(np.int32).tobytes(), 4 * pieces.shape[1]
                for k, (j, n) in enumerate(zip(at[done].tolist(), (4 * sizes[done]).tolist())):
                    out[j] = packed[k * width : k * width + n]
                go = np.flatnonzero(least < _NONE)
                at, sizes, pieces, pairs, i, least, rows = at[go], sizes[go], pieces[go], pairs[go], i[go], least[go], rows[: len(go)]
                if not len(at):
                    break
            # the pair at i becomes one piece; what stands after it moves to the left
            place = np.arange(pieces.shape[1] - 1)
            pieces = np.where(place <= i[:, None], pieces[:, :-1], pieces[:, 1:])
            pieces[rows, i] = least
            pairs = np.where(place[:-1] < i[:, None], pairs[:, :-1], pairs[:, 1:])
            sizes = sizes - 1
            right, left = np.flatnonzero(i + 1 < pieces.shape[1]), np.flatnonzero(i > 0)
            pairs[right, i[right]] = self.look_up(pieces[right, i[right]], pieces[right, i[right] + 1])
            pairs[left, i[left] - 1] = self.look_up(pieces[left, i[left] - 1], pieces[left, i[left]])
        return out

    def fold(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of 1 to ``_WIDTHS[-1]`` bytes that are no pieces themselves."""
        out, low = [b""] * len(words), 0
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for width in _WIDTHS:
            own = np.flatnonzero((sizes > low) & (sizes <= width)).tolist()
            for k in range(0, len(own), _AT_ONCE):
                some = own[k : k + _AT_ONCE]
                for j, ids in zip(some, self._same_size([words[j] for j in some], width)):
                    out[j] = ids
            low = width
        return out


class _Ids(dict):
    """Packed ids by word, for one task: from the table, or for a word that it lacks from the merges or the heap."""

    def __init__(self, table: _Table, ranks: dict[bytes, int], merges: _Merges | None = None):
        super().__init__()
        self.table, self.ranks, self.merges = table, ranks, merges

    def learn(self, words: set[str]) -> None:
        """Ids of words that are new to this task; long ones, and all others without ``merges``, wait until they are asked for."""
        if len(self) > REMEMBERED:
            self.clear()
        new = list(words.difference(self))
        self.update(self.table.look_up(new))
        if self.merges:
            left = [(w, b) for w in new if w not in self and len(b := w.encode()) <= _WIDTHS[-1] and b and b not in self.ranks]
            self.update(zip([w for w, _ in left], self.merges.fold([b for _, b in left])))

    def __missing__(self, word: str) -> bytes:
        out = self[word] = np.array(fold(word.encode(), self.ranks), np.int32).tobytes()
        return out


def _encode(broadcast, pattern: str, text: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = regex.compile(pattern)
        ids = _Ids(*broadcast.value)
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            found = []
            for i, j, part, own in bw.runs(data, offsets):
                split = [words.findall(part[a:b].tobytes().decode()) for a, b in zip(own, own[1:])]
                ids.learn(set().union(*split))
                found += [b"".join(map(ids.__getitem__, x)) for x in split]
            ends = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in found], out=ends[1:])
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.ListArray.from_arrays(pa.array(ends), flat)], [*kept, "ids"])

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", with_text: bool = False, limit: int = CACHE_WORDS) -> DataFrame:
    """``docs`` without its text (unless ``with_text``) with ids: array<int>; ``limit`` words at most are broadcast."""
    docs = docs.drop("ids")
    kept = [c for c in docs.columns if with_text or c != text]
    words = repeated_words(docs, pattern, text, limit)
    release(docs.sparkSession)  # plans that hold the literal take the driver's memory
    folded = encode_words(words.select("word"), ranks)  # no exchange: each plan that is made anew holds the literal anew
    packed = folded.mapInArrow(trimmed(_pack), "hashes binary, checks binary, sizes binary, ids binary")
    table = _Table([tuple(map(bytes, r)) for r in packed.collect()])  # ``limit`` words at most
    drop(words)
    broadcast = docs.sparkSession.sparkContext.broadcast((table, ranks, _Merges(ranks)))
    del table, folded, packed
    release(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name in kept]
    return docs.mapInArrow(trimmed(_encode(broadcast, pattern, text, kept)), T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))]))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``encoded`` with decoded: binary."""
    return encoded.withColumn("decoded", decode_ids(ids, ranks))
