r"""Language-model scoring: a Katz backoff bigram model over all training texts.

Text is lower-cased (A-Z); tokens are words ``[^\x20\x09-\x0D]+``, then one end token.  Counts up to ``K`` are
discounted by Good-Turing, greater ones by ``DELTA``, so that every history keeps mass for what it has not seen.
With r the count of (v, w) and c the count of v:

    P(w | v) = d(r) r / c                        where r > 0
             = a(v) P(w)                         else; a(v) = 1 where v is unknown
    P(w)     = d1(n) n / N                       where n > 0, and what is left for the one unknown word

a(v) is exactly ``(1 - sum of P(w | v) over seen w) / (1 - sum of P(w) over seen w)``, so that each history's
probabilities sum to 1 over the vocabulary and the unknown word.

* Unigrams are counted first; words that make more than 1 in ``HOT`` of all tokens are known to every task (fewer than
  ``HOT`` words).
* Each task packs its distinct bigrams with counts and the documents where they stand, dealt by the word, and a hot
  word's by its history too.  The receiver has all of a word's bigrams, and so both its counts; it gives partial sums
  for documents, and partial sums for histories, as only what a history adds is not known there.
* Histories are gathered with the requests of unseen bigrams, and answer with log a(v).

A partition holds about ``PART_BYTES`` of text, whatever the corpus: their number follows from its size.  What is sent is
packed: sorted hashes by differences, sums in units of 2**-32.  The tables of unigrams and of histories with their weights,
and that of bigrams where asked for, stay in the shared folder, partitioned by part or kind.  Words are 64-bit hashes, and
histories the upper 48 bits of them: with V words, about V**2 / 2**49 pairs of histories are taken for one.

A null or empty text is one end token.  Rows with a null in ``train`` teach nothing.  Repeated rows count as often as
they stand; an empty table gives an empty result; other columns are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw
from docquery.llm.shared import release, stored

K, DELTA, HOT = 5, 0.1, 4096
#: Tokens and documents packed at once by a task.
CHUNK_TOKENS, CHUNK_DOCS = 1_200_000, 60_000
_U = np.uint64
_END, _START = _U(0x7C15A0E5D1B54A33), _U(0x1B873593CC9E2D51)
_LOW = 16
_HISTORY = _U((1 << 48) - 1)
#: Bytes of text for each partition of packed bigrams, and words in a partition of unigrams, about.
PART_BYTES = 12 << 20


@dataclass(frozen=True)
class Discounts:
    """Discount ratios of the counts 1 to K by Good-Turing, from the numbers of types that occur r times."""

    ratios: tuple[float, ...]

    @classmethod
    def of(cls, types: list[int]) -> Discounts:
        """``types[r]`` for r to K + 1.  Where the numbers give no ratio in (0, 1), half a count is taken."""
        n, out = [*types, *[0] * (K + 2)], []
        cut = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        for r in range(1, K + 1):
            ratio = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 0
            out.append(ratio if 0 < ratio < 1 else 1 - 0.5 / r)
        return cls(tuple(out))

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        table = np.array([0.0, *(d * r for r, d in enumerate(self.ratios, 1))])
        return np.where(counts > K, counts - DELTA, table[np.minimum(counts, K)])


@dataclass(frozen=True)
class Unigrams:
    """What every task knows: N, V, the discounts, the number of training documents, and the hot words."""

    tokens: int
    vocabulary: int
    docs: int
    discounts: Discounts
    unknown: float
    hot: np.ndarray
    hot_counts: np.ndarray

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.mass(counts) / max(self.tokens, 1), self.unknown)


def _shrunk(values: np.ndarray) -> bytes:
    """An array by planes of bytes, compressed."""
    return zstandard.compress(np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes(), 1)


def _grown(packed: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _steps(values: np.ndarray) -> bytes:
    """Histories in rising order, or in runs of it, by their differences."""
    return _shrunk(np.diff(values, prepend=_U(0)) & _HISTORY)


def _histories(packed: bytes) -> np.ndarray:
    return np.cumsum(_grown(packed, np.uint64), dtype=np.uint64) & _HISTORY


def _fixed(sums: np.ndarray) -> bytes:
    """Sums of logarithms in units of 2**-32."""
    return _shrunk(np.rint(sums * 2.0**32).astype(np.int64))


def _float(packed: bytes) -> np.ndarray:
    return _grown(packed, np.int64) / 2.0**32


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with the end of each text, the token before each, and the text of each."""
    starts, ends, bounds = bw.word_bounds(data, offsets, bw.SPACED)
    words = bw.word_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds) + 1)
    return np.insert(words, bounds[1:], _END), np.insert(words, bounds[:-1], _START), owner


def _unigram_scan(text: str, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "words", "counts"]
        held, size = [], 0

        def out():
            words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([c for _, c in held])).astype(np.int64)
            own = (words % _U(count)).astype(np.int64)
            rows = [(p, _shrunk(words[own == p]), _shrunk(counts[own == p])) for p in np.unique(own).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names)

        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            train = np.array(batch.column("_train").to_pylist(), object) == True  # noqa: E712
            for i, j, part, own in bw.runs(data, offsets):
                words, _, docs = _tokens(part, own)
                held.append(np.unique(words[train[i:j][docs]], return_counts=True))
                size += len(held[-1][0])
            if size > CHUNK_TOKENS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return run


def _unigram_sums(key, table):
    """Counts of all words of one partition."""
    words = np.concatenate([_grown(x.as_py(), np.uint64) for x in table.column("words")])
    counts = np.concatenate([_grown(x.as_py(), np.int64) for x in table.column("counts")])
    words, at = np.unique(words, return_inverse=True)
    return pa.Table.from_arrays([pa.array(np.full(len(words), key[0].as_py(), np.int32)), pa.array(words.view(np.int64)), pa.array(np.bincount(at, counts).astype(np.int64))], ["part", "word", "n"])


def count_unigrams(docs: DataFrame, text: str, count: int) -> tuple[DataFrame, Unigrams]:
    """The table (part, word, n) and what every task knows of it."""
    packed = docs.select(text, "_train").mapInArrow(_unigram_scan(text, count), "part int, words binary, counts binary")
    table = stored(packed.groupBy("part").applyInArrow(_unigram_sums, "part int, word long, n long"), "katz-unigrams", ["part"])
    low = [F.sum(F.when(F.col("n") == r, 1).otherwise(0)) for r in range(1, K + 2)]
    n, v, *types = (x or 0 for x in table.agg(F.sum("n"), F.count("*"), *low).first())
    hot = table.where(F.col("n") * HOT > n).select("word", "n").orderBy("word").collect()  # fewer than HOT words
    words = np.array([r["word"] for r in hot], np.int64).view(np.uint64)
    order = np.argsort(words)
    discounts = Discounts.of([0, *types])
    seen = sum(d * r * types[r - 1] for r, d in enumerate(discounts.ratios, 1)) + (n - sum(r * types[r - 1] for r in range(1, K + 1))) - DELTA * (v - sum(types[:K]))
    n_docs = table.where(F.col("word") == int(np.array([_END]).view(np.int64)[0])).agg(F.sum("n")).first()[0] or 0
    return table, Unigrams(n, v, n_docs, discounts, 1 - seen / n if n else 1.0, words[order], np.array([r["n"] for r in hot], np.int64)[order])


_COLUMNS = ["w", "per_w", "v", "counts", "places", "docs"]


def _bigram_scan(known, key: str, text: str, count: int):
    """Rows (part, chunk, keys, ...): one with a chunk's documents, and one for each partition with its bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, chunk, kind = TaskContext.get().partitionId() << 24, 0, None
        held, keys, train, n_docs, n_tokens = [], [], [], 0, 0
        hot = known.value.hot

        def out():
            w, v, d = (np.concatenate(x) for x in zip(*held))
            held.clear()
            learn = np.concatenate(train)
            head = np.bincount(d, minlength=len(learn))
            v = v >> _U(_LOW)
            spread = np.isin(w, hot)
            part = (bw.mix(w ^ np.where(spread, v, _U(0))) % _U(count)).astype(np.int32)
            order = np.lexsort((v, w, part))
            w, v, d, part = w[order], v[order], d[order], part[order]
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])])
            first = np.flatnonzero(new)
            places = np.diff(np.append(first, len(w)))
            counts = np.add.reduceat(learn[d].astype(np.int64), first)
            tw, tv, tp = w[first], v[first], part[first]
            cuts, place_cuts = np.searchsorted(tp, np.arange(count + 1)), np.searchsorted(part, np.arange(count + 1))
            name = base + chunk
            rows = [(int(bw.mix(np.array([name], np.uint64))[0] % _U(count)), pa.concat_arrays(keys), [None] * 6)]
            for p in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[p], cuts[p + 1]
                at = np.flatnonzero(np.concatenate([[True], tw[a + 1 : b] != tw[a : b - 1]]))
                rows.append((int(p), None, [
                    _shrunk(tw[a:b][at]), _shrunk(np.diff(np.append(at, b - a)).astype(np.uint32)), _steps(tv[a:b]), _shrunk(counts[a:b].astype(np.uint32)),
                    _shrunk(places[a:b].astype(np.uint32)), _shrunk(d[place_cuts[p] : place_cuts[p + 1]].astype(np.uint16))]))
            rows[0][2][:2] = [_shrunk(head.astype(np.int64)), _shrunk(learn.astype(np.uint8))]
            columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([name] * len(rows), pa.int64()), pa.array([None if r[1] is None else r[1].to_pylist() for r in rows], pa.list_(kind))]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array([r[2][k] for r in rows], pa.binary()) for k in range(6)]], ["part", "chunk", "keys", *_COLUMNS])

        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            own_keys, kind = batch.column(key), batch.column(key).type
            own_train = np.array(batch.column("_train").to_pylist(), object) == True  # noqa: E712
            for i, j, part, own in bw.runs(data, offsets):
                for a in range(i, j, CHUNK_DOCS):
                    b = min(a + CHUNK_DOCS, j)
                    begin, end = own[a - i], own[b - i]
                    w, v, d = _tokens(part[begin:end], own[a - i : b - i + 1] - begin)
                    if n_docs and (n_docs + b - a > CHUNK_DOCS or n_tokens + len(w) > CHUNK_TOKENS):
                        yield out()
                        held, keys, train, n_docs, n_tokens, chunk = [], [], [], 0, 0, chunk + 1
                    held.append((w, v, d + n_docs))
                    keys.append(own_keys.slice(a, b - a))
                    train.append(own_train[a:b])
                    n_docs, n_tokens = n_docs + b - a, n_tokens + len(w)
        if held:
            yield out()

    return run


_FOUND = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("chunk", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in "abcde"], T.StructField("kind", T.StringType())])


def _found(rows: list[tuple], keys: pa.DataType) -> pa.Table:
    """Rows (kind, part, chunk, keys, binaries) as a table of _FOUND with keys."""
    wide = [[*r[4], *[None] * (5 - len(r[4]))] for r in rows]
    columns = [pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()), *[pa.array([x[k] for x in wide], pa.binary()) for k in range(5)]]
    return pa.Table.from_arrays([pa.array([r[3] for r in rows], keys), *columns, pa.array([r[0] for r in rows], pa.string())], ["keys", *_FOUND.names])


def _read(table: pa.Table, column: str, kind) -> list[np.ndarray]:
    return [_grown(x.as_py(), kind) for x in table.column(column)]


def _weigh(known, count: int, bigrams: bool):
    """For the bigrams of one partition: partial sums of documents and of histories, requests, and the counts if asked for."""

    def run(key, table):
        model = known.value
        heads = table.filter(pc.is_valid(table.column("keys")))
        out = [("head", 0, r["chunk"], r["keys"], [r["w"], r["per_w"]]) for r in heads.select(["chunk", "keys", "w", "per_w"]).to_pylist()]
        table, kind = table.filter(pc.is_null(table.column("keys"))), table.schema.field("keys").type
        if not table.num_rows:
            return _found(out, kind)
        chunks = table.column("chunk").to_pylist()
        vs = [_histories(x.as_py()) for x in table.column("v")]
        cuts = np.cumsum([0, *[len(x) for x in vs]])
        w = np.concatenate([np.repeat(a, b) for a, b in zip(_read(table, "w", np.uint64), _read(table, "per_w", np.uint32))])
        v = np.concatenate(vs)
        del vs
        order = np.lexsort((v, w))
        w, v = w[order], v[order]
        new = np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])])
        bigram = np.empty(len(w), np.int32)
        bigram[order] = np.cumsum(new) - 1
        gw, gv = w[new], v[new]
        del w, v, order, new
        r = np.bincount(bigram, np.concatenate(_read(table, "counts", np.uint32))).astype(np.int64)
        first = np.concatenate([[True], gw[1:] != gw[:-1]])
        word, words = np.cumsum(first) - 1, gw[first]
        n = np.bincount(word, r).astype(np.int64)
        if len(model.hot):
            at = np.minimum(np.searchsorted(model.hot, words), len(model.hot) - 1)
            n = np.where(model.hot[at] == words, model.hot_counts[at], n)
        n, p = n[word], model.probability(n)[word]

        seen = np.flatnonzero(r > 0)
        # Most histories have one word here: of those its two counts say all; of the others, sums.
        hv, at, many = np.unique(gv[seen], return_inverse=True, return_counts=True)
        rs, single = r[seen], many[at] == 1
        order = np.argsort(gv[seen][single])
        v1, r1, n1 = (x[seen][single][order] for x in (gv, r, n))
        own = (bw.mix(v1) % _U(count)).astype(np.int64)
        for q in np.unique(own).tolist():
            m = own == q
            out.append(("single", q, 0, None, [_steps(v1[m]), _shrunk(r1[m]), _shrunk(n1[m])]))
        hv, at = np.unique(gv[seen][~single], return_inverse=True)
        r2 = rs[~single]
        tally = np.stack([np.bincount(at, r2 == k, len(hv)).astype(np.uint32) for k in range(1, K + 1)] + [np.bincount(at, r2 > K, len(hv)).astype(np.uint32)])
        total, mass = np.bincount(at, r2 * (r2 > K), len(hv)), np.bincount(at, p[seen][~single], len(hv))
        own = (bw.mix(hv) % _U(count)).astype(np.int64)
        for q in np.unique(own).tolist():
            m = own == q
            out.append(("history", q, 0, None, [_steps(hv[m]), _shrunk(tally[:, m]), _shrunk(total[m].astype(np.float64)), _shrunk(mass[m].astype(np.float64))]))
        out.append(("types", 0, 0, None, [np.bincount(np.minimum(rs, K + 2), minlength=K + 3)[: K + 2].astype(np.int64).tobytes()]))
        if bigrams:
            out.append(("bigrams", key[0].as_py(), 0, None, [_shrunk(gw[seen]), _shrunk(gv[seen]), _shrunk(rs)]))
        del hv, at, many, order, v1, r1, n1, own, r2, tally, total, mass, single, rs

        with np.errstate(divide="ignore"):
            value = np.where(r > K, np.log10(np.maximum(r - DELTA, DELTA)), np.where(r > 0, np.log10(np.maximum(r, 1)), np.log10(p)))
        value -= np.where((n > 0) & (gw != _END), np.log10(np.maximum(n, 1)), 0.0)
        base = np.log10((n + 1) / (model.tokens + model.vocabulary + 1))
        del p, word, words, first
        places, docs = table.column("places"), table.column("docs")
        for c, chunk in enumerate(chunks):  # the places of one chunk at a time
            t = np.repeat(bigram[cuts[c] : cuts[c + 1]], _grown(places[c].as_py(), np.uint32))
            doc = _grown(docs[c].as_py(), np.uint16)
            ids, at = np.unique(doc, return_inverse=True)
            rt = r[t]
            sums = [np.bincount(at, x[t], len(ids)) for x in (base, value)] + [np.bincount(at, n[t] > 0, len(ids)).astype(np.uint32)]
            low_counts = np.stack([np.bincount(at, rt == k, len(ids)).astype(np.uint32) for k in range(1, K + 1)])
            out.append(("docs", 0, chunk, None, [_shrunk(ids), _fixed(sums[0]), _fixed(sums[1]), _shrunk(sums[2]), _shrunk(low_counts)]))
            ask = np.flatnonzero(rt == 0)
            asked, doc = gv[t[ask]], doc[ask]
            own = (bw.mix(asked) % _U(count)).astype(np.int64)
            order = np.argsort(own, kind="stable")
            asked, doc, own = asked[order], doc[order], own[order]
            for q in np.unique(own):
                a, b = np.searchsorted(own, [q, q + 1])
                out.append(("requests", int(q), chunk, None, [_shrunk(asked[a:b]), _shrunk(doc[a:b])]))
        return _found(out, kind)

    return run


def _answer(known, discounts: Discounts, kind: pa.DataType):
    """Backoff weights of one partition's histories, and the sums of documents that asked for them."""

    def run(key, table):
        model, kinds = known.value, np.array(table.column("kind").to_pylist())
        own, single, asks = (table.filter(pa.array(kinds == k)) for k in ("history", "single", "requests"))
        none, nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first = [_histories(x.as_py()) for x in own.column("a")]
        v1 = np.concatenate([none, *[_histories(x.as_py()) for x in single.column("a")]])
        r1, n1 = (np.concatenate([nothing, *_read(single, c, np.int64)]) for c in "bc")
        v, at = np.unique(np.concatenate([none, *first, v1]), return_inverse=True)
        at, at1 = at[: len(at) - len(v1)], at[len(at) - len(v1) :]
        tally = np.concatenate([np.zeros((K + 1, 0), np.uint32), *[x.reshape(K + 1, -1) for x in _read(own, "b", np.uint32)]], axis=1)
        total, mass = (np.bincount(at, np.concatenate([np.zeros(0), *_read(own, c, np.float64)]), len(v)).astype(np.float64) for c in "cd")
        tally = np.stack([np.bincount(at, x, len(v)).astype(np.float64) for x in tally])
        for k in range(1, K + 1):
            tally[k - 1] += np.bincount(at1, r1 == k, len(v))
        tally[K] += np.bincount(at1, r1 > K, len(v))
        total += np.bincount(at1, r1 * (r1 > K), len(v))
        mass += np.bincount(at1, model.probability(n1), len(v))
        del first, v1, r1, n1, at, at1
        low = np.arange(1, K + 1)[:, None] * tally[:K]
        count = low.sum(axis=0) + total
        left = ((1 - np.array(discounts.ratios))[:, None] * low).sum(axis=0) + DELTA * tally[K]
        weight = left / np.maximum(count, 1) / np.maximum(1 - mass, 1e-300)
        out = [("weights", key[0].as_py(), 0, None, [_shrunk(v), _shrunk(count), _shrunk(weight)])]
        value = np.log10(weight) + np.log10(count)
        for chunk, asked, doc in zip(asks.column("chunk").to_pylist(), _read(asks, "a", np.uint64), _read(asks, "b", np.uint16)):
            at = np.minimum(np.searchsorted(v, asked), max(len(v) - 1, 0))
            got = np.where(v[at] == asked, value[at], 0.0) if len(v) else np.zeros(len(asked))
            ids, at = np.unique(doc, return_inverse=True)
            out.append(("answers", 0, chunk, None, [_shrunk(ids), _fixed(np.bincount(at, got))]))
        return _found(out, kind)

    return run


def _finish(model: Unigrams, discounts: Discounts, schema: list[str]):
    """The scores of one chunk's documents."""

    def run(key, table):
        kinds = table.column("kind").to_pylist()
        head = kinds.index("head")
        keys = table.column("keys")[head].values
        tokens, learn = (_grown(table.column(c)[head].as_py(), t) for c, t in (("a", np.int64), ("b", np.uint8)))
        n = len(tokens)
        known, base, score = np.zeros(n, np.int64), np.zeros(n), np.full(n, -np.log10(model.docs) if model.docs else 0.0)
        ratios = np.log10(discounts.ratios)
        for kind, a, b, c, d, e in zip(kinds, *(table.column(x).to_pylist() for x in "abcde")):
            if kind == "head":
                continue
            at = _grown(a, np.uint16)
            if kind == "answers":
                score[at] += _float(b)
                continue
            base[at] += _float(b)
            score[at] += _float(c) + ratios @ _grown(e, np.uint32).reshape(K, -1)
            known[at] += _grown(d, np.uint32)
        return pa.Table.from_arrays([keys, pa.array(learn.astype(bool)), pa.array(tokens), pa.array(known), pa.array(np.full(n, model.tokens, np.int64)), pa.array(base), pa.array(score)], schema)

    return run


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", bigrams: bool = False) -> DataFrame:
    """(key, learned, n_tokens, n_known, train_tokens, base_score, score) of every row; ``train`` marks what is learned from.

    ``bigrams`` keeps the table of bigram counts too, beside those of unigrams and histories; the scores do not read it.
    """
    spark = docs.sparkSession
    docs = docs.select(key, text, train.alias("_train"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    _, model = count_unigrams(docs, text, count)
    known = spark.sparkContext.broadcast(model)
    keys = T.StructField("keys", T.ArrayType(docs.schema[key].dataType))
    packed = docs.mapInArrow(_bigram_scan(known, key, text, count), T.StructType([T.StructField("part", T.IntegerType()), T.StructField("chunk", T.LongType()), keys, *[T.StructField(c, T.BinaryType()) for c in _COLUMNS]]))
    found_schema = T.StructType([keys, *_FOUND.fields])
    found = stored(packed.groupBy("part").applyInArrow(_weigh(known, count, bigrams), found_schema), "katz-counts", ["kind"])
    del packed
    release(spark)
    types = np.zeros(K + 2, np.int64)
    for r in found.where("kind = 'types'").select("a").toLocalIterator():
        types += np.frombuffer(r["a"], np.int64)
    discounts = Discounts.of(types.tolist())
    sides = found.where("kind IN ('history', 'single', 'requests')")
    kind = _arrow_type(found)
    weights = stored(sides.groupBy("part").applyInArrow(_answer(known, discounts, kind), found_schema), "katz-weights", ["kind"])
    rows = found.where("kind IN ('head', 'docs')").unionByName(weights.where("kind = 'answers'"))
    names = [key, "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types_ = [T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    return rows.groupBy("chunk").applyInArrow(_finish(model, discounts, names), T.StructType([docs.schema[key], *[T.StructField(c, t) for c, t in zip(names[1:], types_)]]))


def _arrow_type(found: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(found.schema["keys"].dataType)
