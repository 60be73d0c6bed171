r"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics are worked out in numpy for many texts at once.  Trees are full binary trees of one depth, flattened into
arrays of features, cuts and leaf values, and all trees are walked together by index arithmetic.

Training takes a bounded sample: of the labelled rows, the ``SAMPLE_ROWS`` with the smallest hash of the id.  A
document with several labels has their mean, rounded; null ids and null labels teach nothing.  Without labels of both
classes the score is the share of class 1 (0.5 without any).  Null and empty texts have statistics of zero and are
scored like any other.  Repeated rows are scored row by row; an empty table gives an empty result; further columns
pass through, and those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw

#: Bound of the training sample, and the shape of the model.
SAMPLE_ROWS, TREES, DEPTH, BINS, RATE, L2 = 20_000, 60, 4, 64, 0.2, 1.0
# Frequent function words of the corpus's languages.
STOP_WORDS = "the of and to in a is that it for le la les de des du et un une der die das und ist von el los las del y por con".split()
_SETS = {
    "digits": "0123456789",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "symbols": "#*$%&|<>",
    "brackets": "(){}[]=;/\\_~^`",
    "stops": ".?",
    "shouts": "!",
    "commas": ",:",
    "lines": "\n",
}
NAMES = ["log_bytes", "log_words", "word_length", *_SETS, "beyond_ascii", "spaces", "distinct_words", "top_word", "distinct_windows", "stop_words", "longest_word", "words_a_line"]
_MASKS = np.array([[chr(b) in s for b in range(128)] + [False] * 128 for s in _SETS.values()])


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    per_byte = np.maximum(size, 1)
    out = np.zeros((n, len(NAMES)))

    def totals(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return np.diff(sums[offsets])

    starts, ends, bounds = bw.word_bounds(data, offsets, bw.SPACED)
    words = np.diff(bounds)
    per_word = np.maximum(words, 1)
    hashes = bw.word_hashes(data, starts, ends)
    docs = np.repeat(np.arange(n), words)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(words)
    lengths = ends - starts
    out[:, 2] = np.bincount(docs, lengths, n) / per_word
    for k, mask in enumerate(_MASKS):
        out[:, 3 + k] = totals(mask[data]) / per_byte
    k = 3 + len(_SETS)
    out[:, k] = totals(data >= 0x80) / per_byte
    out[:, k + 1] = totals(~bw.SPACED[data]) / per_byte
    distinct, top = _distinct(docs, hashes, n)
    out[:, k + 2], out[:, k + 3] = distinct / per_word, top / per_word
    at, owner = bw.window_docs(bounds, 3)
    distinct, _ = _distinct(owner, bw.window_hashes(hashes, 3)[at], n)
    out[:, k + 4] = distinct / np.maximum(words - 2, 1)
    out[:, k + 5] = np.bincount(docs[np.isin(hashes, _stop_hashes())], minlength=n) / per_word
    longest = np.zeros(n)
    np.maximum.at(longest, docs, lengths)
    out[:, k + 6] = np.log1p(longest)
    out[:, k + 7] = words / (totals(data == 10) + 1)
    return out


def _stop_hashes() -> np.ndarray:
    data, offsets = bw.buffers(pa.array([" ".join(STOP_WORDS)]))
    starts, ends, _ = bw.word_bounds(data, offsets, bw.SPACED)
    return bw.word_hashes(data, starts, ends)


def _distinct(docs: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes of each text, and the count of the most frequent; by 40 bits of each hash."""
    keys = np.sort((docs.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    owner = (keys[firsts] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, np.diff(np.append(firsts, len(keys))))
    return np.bincount(owner, minlength=n), top


@dataclass
class Forest:
    """Full binary trees: inner node k of a tree has the children 2k + 1 and 2k + 2."""

    bias: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = self.features.shape
        if not trees:
            return np.full(len(rows), 1 / (1 + np.exp(-self.bias)))
        node = np.zeros((len(rows), trees), np.int64)
        tree = np.arange(trees)[None, :]
        for _ in range((inner + 1).bit_length() - 1):
            right = np.take_along_axis(rows, self.features[tree, node], axis=1) > self.cuts[tree, node]
            node = 2 * node + 1 + right
        return 1 / (1 + np.exp(-(self.bias + self.leaves[tree, node - inner].sum(axis=1))))


def train(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, l2: float = L2) -> Forest:
    """Boosting of the logistic loss; a level of a tree is one histogram over (node, feature, bin)."""
    inner = (1 << depth) - 1
    share = labels.mean() if len(labels) else 0.5
    empty = Forest(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(labels) or not 0 < share < 1:
        return empty
    m, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    base = binned + np.arange(width) * bins
    features, cuts, leaves = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    raw = np.full(m, empty.bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - labels, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(m, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            slot = ((node - first)[:, None] * (width * bins) + base).ravel()
            G, H = (np.bincount(slot, np.repeat(x, width), count * width * bins).reshape(count, width, bins).cumsum(axis=2) for x in (g, h))
            gt, ht = G[:, :, -1:], H[:, :, -1:]
            gain = G**2 / (H + l2) + (gt - G) ** 2 / (ht - H + l2) - gt**2 / (ht + l2)
            gain[(H < 1e-3) | (ht - H < 1e-3)] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    features[t, first + k], cuts[t, first + k] = f, edges[f][b]
            own = features[t, node]
            node = 2 * node + 1 + (rows[np.arange(m), own] > cuts[t, node])
        leaf = node - inner
        leaves[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        raw += leaves[t, leaf]
    return Forest(empty.bias, features, cuts, leaves)


def _over_texts(text: str, kept: list[str], columns):
    """``columns`` makes the new columns from a matrix of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            parts = [statistics(part, own) for _, _, part, own in bw.runs(data, offsets)]
            new = columns(np.concatenate(parts) if parts else np.zeros((0, len(NAMES))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new.values()], [*kept, *new])

    return run


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE_ROWS) -> Forest:
    """A forest from ``sample`` labelled documents at most.  ``labels`` are the rows that may be learned from."""
    one = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.avg(label).alias("_label"))
    one = one.orderBy(F.xxhash64(key), key).limit(sample)
    picked = docs.select(key, text).join(F.broadcast(one), key)  # ``sample`` rows at most

    def arrays(stats: np.ndarray) -> dict:
        return {"_stats": pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))}

    rows = picked.mapInArrow(_over_texts(text, [key, "_label"], arrays), T.StructType([picked.schema[key], T.StructField("_label", T.DoubleType()), T.StructField("_stats", T.ArrayType(T.DoubleType()))]))
    got = rows.orderBy(F.xxhash64(key), key, "_stats").limit(sample).collect()
    return train(np.array([r["_stats"] for r in got]).reshape(len(got), len(NAMES)), np.array([float(r["_label"] >= 0.5) for r in got]))


def classify(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """``docs`` without its text, with score and predicted."""
    docs = docs.drop(*(c for c in ("score", "predicted") if c in docs.columns))
    kept = [c for c in docs.columns if c != text]

    def columns(stats: np.ndarray) -> dict:
        score = forest.score(stats)
        return {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

    fields = [docs.schema[c] for c in kept]
    return docs.mapInArrow(_over_texts(text, kept, columns), T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
