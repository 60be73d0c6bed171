r"""N-gram Jaccard join: T-occurrence search with DivideSkip.

Text is lower-cased (A-Z) and cut into words ``[^\x20\x09-\x0D]+``.  A document's set is its distinct shingles of five
words, as 64-bit hashes; with fewer words the whole sequence is one shingle; without words the set is empty and linked
with nothing.  Two documents link when ``100 * intersection >= threshold * union``.

1. One scan gives each document its set's size and 64-bit identity, and counts shingles in a table of fixed size.
   Documents with equal sets are one set from here on.
2. In any order common to all, a linked pair shares ``l`` of the first ``n - ceil(t n) + l`` shingles of either set,
   where l is a tenth of the smaller set's size (``depth``).  The order is by the counts, so that a passage of many documents comes
   last.  The sets that have such a shingle, and sizes that may link, have the largest of them as leader.  A set that
   shares fewer than ``l`` of its shingles links with nothing and goes.
3. A leader and its members are a block; where a leader is in a larger block, its members go there instead.  Each pair
   that may link is together in a block.  Whole sets are sent to their blocks only.  There an inverted index answers T-occurrence searches: the short lists of a set's shingles are merged
   by a heap that skips, the long ones probed by binary search.  A set that a search has linked to is not searched
   itself while one component is left; then all sets outside the largest component are.
4. A block of more than ``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles is searched in parts, each with the block's
   leader and its best connected member, the hub.  Every set that is not in the hub's component after that is searched
   in all parts of the block.  So no link between different components is missed, and the parts of a block meet only
   for the sets that are left over.
5. Components of the verified links give each document the least id it reaches.

Null and empty texts, and texts of white space, link with nothing.  Repeated rows are equal documents.  A null id is
never the least; an empty table gives an empty result.  Columns of the input other than the key are not kept.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm import bytewords as bw
from docquery.llm.components import components
from docquery.llm.shared import drop, parts, release, stored, trimmed

SHINGLE, THRESHOLD = 5, 75
#: Sets and shingles in a part of a block; shingles of all blocks that one group of tasks' rows holds, about.
BLOCK_SETS, BLOCK_SHINGLES, BUCKET_SHINGLES = 256, 500_000, 1_000_000
#: Shared shingles of the first that a link needs: one in so many.
DEPTH = 10
#: Shingles packed at once by a task, sets in them, and shingles of a bin, about; identities that a task remembers.
PACKED, PACKED_SETS, BIN_SHINGLES, SEEN = 1_500_000, 60_000, 4_000_000, 1 << 20
#: Long lists that are searched at once.
PROBED = 32
#: log2 of the counters for shingles, and their rows.
_COUNTERS, _ROWS = 20, 16
#: Bytes of a bit map that the driver gets at a time.
PIECES = 1 << 23
#: A key with many rows is dealt by so many values of another column too.
_SALTS = 16
_U = np.uint64


def required(n: int, threshold: int) -> int:
    """Least overlap of a set of n with any set that it links to."""
    return -(-threshold * n // 100)


def depth(n):
    """Shingles of the first that a set of n shares with a set that it links to and that is not smaller."""
    return np.maximum(1, n // DEPTH)


class _Seen:
    """Whether identities are new to this task; it forgets all where they are too many, so that some are new again."""

    def __init__(self, limit: int = SEEN):
        self.ids, self.limit = set(), limit

    def new(self, ids: list[int]) -> np.ndarray:
        if len(self.ids) > self.limit:
            self.ids.clear()
        return np.array([not (x in self.ids or self.ids.add(x)) for x in ids], bool)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each; bounds of the texts in them; identity of each set."""
    starts, ends, bounds = bw.word_bounds(data, offsets, bw.SPACED)
    words = bw.word_hashes(data, starts, ends)
    at, docs = bw.window_docs(bounds, n)
    hashes = [bw.window_hashes(words, n)[at]]
    owners = [docs]
    for k in range(1, n):
        short = np.flatnonzero(np.diff(bounds) == k)
        if len(short):
            hashes.append(bw.mix(bw.window_hashes(words, k)[bounds[short]] ^ _U(k)))
            owners.append(short)
    h, d = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    if len(h):
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
        h, d = h[keep], d[keep]
    cuts = np.searchsorted(d, np.arange(len(offsets)))
    sums = np.zeros(len(h) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(bw.mix(h + _U(0x9E3779B97F4A7C15)), out=sums[1:])
        ids = bw.mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ (np.diff(cuts).astype(np.uint64) * _U(0xD6E8FEB86659FD93)))
    return h, cuts, ids.view(np.int64)


def _first_scan(key: str, text: str, n: int):
    names = [key, "n_shingles", "set", "row", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << _COUNTERS, np.int64), _Seen()
        kind = None
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, part, own in bw.runs(data, offsets):
                h, cuts, own_ids = shingle_sets(part, own, n)
                new = seen.new(own_ids.tolist())
                picked = h[np.repeat(new, np.diff(cuts))]
                counts += np.bincount((picked >> _U(64 - _COUNTERS)).astype(np.int64), minlength=len(counts))
                sizes.append(np.diff(cuts))
                ids.append(own_ids)
            keys, m = batch.column(key), batch.num_rows
            kind = keys.type
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate(sizes)), pa.array(np.concatenate(ids)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if kind is not None:
            rows = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32).reshape(_ROWS, -1)
            empty = pa.nulls(_ROWS, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(_ROWS, kind), empty, empty, pa.array(range(_ROWS), pa.int32()), pa.array([_packed(r) for r in rows], pa.binary())], names)

    return run


def _packed(counts: np.ndarray) -> bytes:
    """Counters by planes of bytes, compressed: most of the upper bytes are 0."""
    return zlib.compress(counts.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counters of one task's rows, added up."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, counts in zip(batch.column("row").to_pylist(), batch.column("counts").to_pylist()):
            own = _unpacked(counts).astype(np.uint64)
            totals[row] = totals[row] + own if row in totals else own
    yield pa.RecordBatch.from_arrays(
        [pa.array(totals, pa.int32()), pa.array([np.minimum(v, _U(0xFFFFFFFF)).astype(np.uint32).tobytes() for v in totals.values()], pa.binary())], ["row", "counts"])


def _prefixes(table, text: str, n: int, threshold: int, bins: int):
    """For each bin of shingles, the first of all sets: packed rows (bin, keys, owners, sets, sizes).

    A key is the 32 bits of a shingle above those that give its bin; keys that agree by chance only add candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, held, size, n_sets = table.value, _Seen(), [], 0, 0

        def out():
            keys, owner, ids, sizes = (np.concatenate(x) for x in zip(*held))
            own = (keys % _U(bins)).astype(np.int64)
            order = np.argsort(own, kind="stable")
            cuts = np.searchsorted(own[order], np.arange(bins + 1))
            keys = (keys >> _U(32)).astype(np.uint32)
            rows = []
            for b in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[b] : cuts[b + 1]]
                sets, where = np.unique(owner[at], return_inverse=True)
                where = where.astype(np.uint16 if len(sets) <= 1 << 16 else np.uint32)
                rows.append((int(b), keys[at].tobytes(), where.tobytes(), ids[sets].tobytes(), sizes[sets].tobytes()))
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["bin", "keys", "owners", "sets", "sizes"])

        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            for _, _, part, own in bw.runs(data, offsets):
                h, cuts, ids = shingle_sets(part, own, n)
                sizes = np.diff(cuts)
                new = seen.new(ids.tolist()) & (sizes > 0)
                h, docs = h[np.repeat(new, sizes)], np.repeat(np.arange(len(sizes))[new], sizes[new])
                if not len(h):
                    continue
                if n_sets + int(new.sum()) > PACKED_SETS and held:
                    yield out()
                    held, size, n_sets = [], 0, 0
                order = np.lexsort((h, counts[(h >> _U(64 - _COUNTERS)).astype(np.int64)], docs))
                h, docs = h[order], docs[order]
                first = np.searchsorted(docs, docs)
                keep = np.arange(len(h)) - first < (sizes - -(-threshold * sizes // 100) + depth(sizes))[docs]
                owner = (np.cumsum(new) - 1)[docs[keep]] + n_sets
                held.append((h[keep], owner, ids[new], sizes[new]))
                n_sets += int(new.sum())
                size += int(keep.sum())
                if size > PACKED:
                    yield out()
                    held, size, n_sets = [], 0, 0
        if held:
            yield out()

    return run


def _shared(threshold: int):
    """(leader, set, size, n) of one bin: n of the set's shingles are in lists that the leader is the largest of.

    A list is cut where sizes leave a gap that no link spans; lists of one set are none.
    """

    def run(key, table):
        keys, ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in table.to_batches():
            for k, o, s, z in zip(*(batch.column(c).to_pylist() for c in ("keys", "owners", "sets", "sizes"))):
                owner = np.frombuffer(o, np.uint16 if 2 * len(o) == len(k) else np.uint32)
                keys.append(np.frombuffer(k, np.uint32))
                ids.append(np.frombuffer(s, np.int64)[owner])
                sizes.append(np.frombuffer(z, np.int64)[owner])
        k, i, z = np.concatenate(keys), np.concatenate(ids), np.concatenate(sizes)
        del keys, ids, sizes, table
        order = np.argsort(k, kind="stable")
        same = k[order][1:] == k[order][:-1]
        many = np.zeros(len(k), bool)
        many[1:] |= same
        many[:-1] |= same
        order = order[many]
        k, i, z = k[order], i[order], z[order]
        order = np.lexsort((i, -z, k))
        k, i, z = k[order], i[order], z[order]
        new = (k[1:] != k[:-1]) | (100 * z[1:] < threshold * z[:-1])
        firsts = np.flatnonzero(np.concatenate([[True], new])) if len(k) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(firsts, len(k)))
        leader, real = np.repeat(i[firsts], lengths), np.repeat(i[firsts] != i[firsts + lengths - 1], lengths)
        leader, i, z = leader[real], i[real], z[real]
        order = np.lexsort((i, leader))
        leader, i, z = leader[order], i[order], z[order]
        at = np.flatnonzero(np.concatenate([[True], (leader[1:] != leader[:-1]) | (i[1:] != i[:-1])])) if len(i) else np.zeros(0, np.int64)
        return pa.Table.from_arrays([pa.array(leader[at]), pa.array(i[at]), pa.array(z[at]), pa.array(np.diff(np.append(at, len(i))))], ["leader", "set", "size", "n"])

    return run


def _whole_sets(bits, text: str, n: int):
    """(set, shingles) of sets whose identity is marked in a bit map; each once for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = bits.value, _Seen()
        shift = _U(64 - (len(marks) * 8).bit_length() + 1)
        for batch in batches:
            data, offsets = bw.buffers(batch.column(text))
            for _, _, part, own in bw.runs(data, offsets):
                h, cuts, ids = shingle_sets(part, own, n)
                slot = (ids.view(np.uint64) >> shift).astype(np.int64)
                hit = np.flatnonzero((marks[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                hit = hit[seen.new(ids[hit].tolist())]
                rows = [(int(ids[d]), h[cuts[d] : cuts[d + 1]].tobytes()) for d in hit]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["set", "shingles"])

    return run


def divide_skip(lists: list, least: int, probe=None) -> list[tuple[int, int]]:
    """(document, number of lists that hold it) of the documents in ``least`` of the sorted lists or more.

    ``least - 1`` of the longest lists at most are set aside: a document in ``least`` lists is in
    ``least - len(aside)`` of the others, which a heap merges.  Where fewer lists agree, the heap skips: the lists
    that stand below jump to the next document that could still reach the number.  The documents that are left are
    looked up in the long lists by binary search, the shortest first, while they can reach ``least``.

    ``probe(k, documents)`` says which of the documents are in the k-th list; the lists themselves are searched without it.
    """
    if len(lists) < least:
        return []
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    aside = min(least - 1, len(lists) - 1)
    short, long = [lists[k] for k in order[: len(lists) - aside]], order[len(lists) - aside :]
    need, found, counts = least - aside, [], []
    heap = [(x[0], k) for k, x in enumerate(short)]
    heapq.heapify(heap)
    at = [0] * len(short)
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            found.append(top)
            counts.append(len(popped))
            target = top + 1
        else:
            for _ in range(need - 1 - len(popped)):
                if heap:
                    popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            target = heap[0][0]
        for k in popped:
            x = short[k]
            at[k] = at[k] + 1 if target == top + 1 else bisect_left(x, target, at[k])
            if at[k] < len(x):
                heapq.heappush(heap, (x[at[k]], k))
    documents, counts, done = np.array(found, np.int64), np.array(counts, np.int64), 0
    while done < len(long) and len(documents):
        some = long[done : done + PROBED]
        if probe is None:
            hits = [[(p := bisect_left(lists[k], d)) < len(lists[k]) and lists[k][p] == d for d in documents.tolist()] for k in some]
        else:
            hits = probe(some, documents)
        counts += np.sum(hits, axis=0)
        done += len(some)
        keep = counts + len(long) - done >= least
        documents, counts = documents[keep], counts[keep]
    keep = counts >= least
    return list(zip(documents[keep].tolist(), counts[keep].tolist()))


def _shared_keys(sets: list[np.ndarray], slices: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that two sets of a block or more have, sorted, with the sets that have them; a slice of hashes at a time."""
    edges = [_U(k) << _U(60) for k in range(1, slices)]
    cuts = np.array([[0, *np.searchsorted(s, edges), len(s)] for s in sets])
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for k in range(slices):
        own = np.concatenate([s[a:b] for s, a, b in zip(sets, cuts[:, k], cuts[:, k + 1])])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), cuts[:, k + 1] - cuts[:, k])
        order = np.argsort(own, kind="stable")
        own, owner = own[order], owner[order]
        same = own[1:] == own[:-1]
        keep = np.zeros(len(own), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keys.append(own[keep])
        owners.append(owner[keep])
    return np.concatenate(keys), np.concatenate(owners)


class _Index:
    """Inverted lists of a block's sets and a forest of what is linked so far."""

    def __init__(self, sets: list[np.ndarray], threshold: int):
        self.sets, self.threshold = sets, threshold
        keys, owner = _shared_keys(sets)
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.lists = memoryview(owner)  # slices of it are no copies
        self.owner = owner
        self.names, self.firsts, self.lasts = keys[firsts], firsts, np.append(firsts[1:], len(keys))
        self.parent, self.left = list(range(len(sets))), len(sets)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.left -= 1

    def search(self, q: int) -> list[int]:
        """The sets that q links to; they are joined to it."""
        if not len(self.names):
            return []
        size, found = len(self.sets[q]), []
        at = np.minimum(np.searchsorted(self.names, self.sets[q]), len(self.names) - 1)
        at = at[self.names[at] == self.sets[q]]
        least = required(size, self.threshold)
        if len(at) < least:
            return found
        starts, ends = self.firsts[at], self.lasts[at]
        for other, count in divide_skip([self.lists[a:b] for a, b in zip(starts.tolist(), ends.tolist())], least, lambda some, d: self._held(starts[some], ends[some], d)):
            if other != q and 100 * count >= self.threshold * (size + len(self.sets[other]) - count):
                found.append(other)
                self.join(q, other)
        return found


    def _held(self, starts: np.ndarray, ends: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Whether each list (rows) holds each document (columns), by one binary search of all in step."""
        low, high = np.repeat(starts[:, None], len(documents), axis=1), np.repeat(ends[:, None], len(documents), axis=1)
        end = high.copy()
        for _ in range(int((ends - starts).max()).bit_length()):
            mid = (low + high) >> 1
            below = (self.owner[np.minimum(mid, len(self.owner) - 1)] < documents) & (low < high)
            low, high = np.where(below, mid + 1, low), np.where(below, high, mid)
        return (low < end) & (self.owner[np.minimum(low, len(self.owner) - 1)] == documents)


def search_block(ids: list[int], sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """(identity, root) of all sets of one block, linked as far as their component in the block goes."""
    n, index = len(ids), _Index(sets, threshold)
    covered, asked = [False] * n, [False] * n
    for q in sorted(range(n), key=lambda k: (len(sets[k]), ids[k])):
        if index.left == 1:
            break
        if not covered[q]:
            asked[q] = covered[q] = True
            for other in index.search(q):
                covered[other] = True
    if index.left > 1:
        roots = [index.find(q) for q in range(n)]
        largest = np.bincount(roots).argmax()
        for q in range(n):
            if not asked[q] and roots[q] != largest and index.left > 1:
                index.search(q)
    return [(ids[q], ids[index.find(q)]) for q in range(n)]


def search_parts(ids: list[int], sets: list[np.ndarray], roots: list[int], asked: list[bool], hub: int, threshold: int) -> list[tuple[int, int]]:
    """(identity, root) after the searches of the asked sets, where ``roots`` says what is linked already.

    One set of each component comes first, and a set that is then in the hub's component is not searched: all sets
    that are not are asked, so each link between the two is found from the other side.
    """
    index, first, main = _Index(sets, threshold), {}, None
    for q, root in enumerate(roots):
        index.join(first.setdefault(root, q), q)
        if root == hub:
            main = q
    firsts = set(first.values())
    for q in sorted(range(len(ids)), key=lambda q: q not in firsts):
        if asked[q] and index.left > 1 and (main is None or index.find(q) != index.find(main)):
            index.search(q)
    return [(ids[q], ids[index.find(q)]) for q in range(len(ids))]


_PLACED = ["leader", "part", "parts", "cell", "hub", "set", "root", "asked"]
_FOUND = "leader long, part int, parts int, hub long, set long, root long, size long"


def _search(threshold: int, by_query: bool):
    """What is linked in the blocks, or the cells of blocks, of one bucket: (.., set, root, size).

    A set's root is the hub where they are linked.  Sets of whole blocks that are linked with nothing are left out.
    """

    def run(key, table):
        blocks: dict[tuple, dict[int, tuple]] = {}
        for batch in table.to_batches():
            columns = [batch.column(c).to_pylist() for c in (*_PLACED, "shingles")]
            for leader, part, parts_, cell, hub, one, root, asked, shingles in zip(*columns):
                rows = blocks.setdefault((leader, part, parts_, cell, hub), {})
                asked = asked or (one in rows and rows[one][2])
                rows[one] = (np.frombuffer(shingles, np.uint64), root, asked)
        del table
        out = []
        while blocks:
            (leader, part, parts_, _, hub), rows = blocks.popitem()
            ids, (sets, roots, asked) = list(rows), zip(*rows.values())
            if by_query:
                found = search_parts(ids, sets, roots, asked, hub, threshold)
            else:
                found = search_block(ids, sets, threshold) if len(ids) > 1 else [(ids[0], ids[0])]
            main = dict(found).get(hub)
            for (one, root), own in zip(found, sets):
                root = hub if root == main else root
                if one != root or parts_ > 1 and not by_query:
                    out.append((leader, part, parts_, hub, one, root, len(own)))
        columns = list(zip(*out)) if out else [()] * 7
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4))], ["leader", "part", "parts", "hub", "set", "root", "size"])

    return run


def _marked(groups: DataFrame, column: str, count: int) -> np.ndarray:
    """Bit map of identities: 16 bits for each, 2**30 bits at most; identities that only share a bit are dropped later.

    Tasks make the map in parts, so the driver gets its fixed size once and no identities.  It gets ``PIECES`` bytes at a
    time: each partition of a local iterator is a job of its own, and the driver keeps what it knows of every job.
    """
    log = min(30, max(16, (16 * count - 1).bit_length()))
    slot = F.shiftrightunsigned(F.col(column), 64 - log)
    words = groups.select(F.shiftrightunsigned(slot, 20).cast("int").alias("piece"), (slot.bitwiseAND((1 << 20) - 1)).cast("int").alias("bit"))

    def run(key, table):
        out = np.zeros(1 << min(17, log - 3), np.uint8)
        bit = table.column("bit").to_numpy()
        np.bitwise_or.at(out, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["piece", "bits"])

    marks = np.zeros(1 << (log - 3), np.uint8)
    pieces = words.distinct().groupBy("piece").applyInArrow(run, "piece int, bits binary")
    for r in pieces.coalesce(-(-len(marks) // PIECES)).toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        marks[r["piece"] * len(part) : (r["piece"] + 1) * len(part)] = part
    return marks


def _salted(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join of the rows of members with ``few``, a row for each of their keys: a hot key is dealt to ``_SALTS`` tasks."""
    few = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("set"), F.lit(_SALTS)).cast("int")).join(few, [*keys, "_salt"], how).drop("_salt")


def _merged(members: DataFrame) -> DataFrame:
    """(leader, set, size, n) where the members of a leader that is in a larger block are members of the largest such block."""
    counts = members.groupBy("leader").agg(F.count("*").alias("_n"))
    within = _salted(members, counts, ["leader"]).join(counts.select(F.col("leader").alias("set"), F.col("_n").alias("_own")), "set")
    larger = within.where((F.col("_n") > F.col("_own")) | ((F.col("_n") == F.col("_own")) & (F.col("leader") > F.col("set"))))
    moved = larger.groupBy(F.col("set").alias("leader")).agg(F.max_by("leader", F.struct("_n", "leader")).alias("_to"))
    out = _salted(members, moved, ["leader"], "left").withColumn("leader", F.coalesce("_to", "leader"))
    return out.groupBy("leader", "set").agg(F.first("size").alias("size"), F.sum("n").alias("n"))


def _dealt(rows: DataFrame, whole: DataFrame, threshold: int, shingles: int, by_query: bool) -> DataFrame:
    """``_FOUND`` from a search of every block or cell of ``rows`` with its whole sets."""
    buckets = max(rows.sparkSession.sparkContext.defaultParallelism, -(-shingles // BUCKET_SHINGLES))
    placed = rows.select(_PLACED).join(whole, "set").withColumn("_bucket", F.pmod(F.xxhash64("leader", "part", "cell"), F.lit(buckets)))
    return placed.groupBy("_bucket").applyInArrow(_search(threshold, by_query), _FOUND)


def _cells(found: DataFrame) -> DataFrame:
    """Cells of the parted blocks that have sets outside the hub's component: a part's sets with a part of those that are asked."""
    rows = found.where((F.col("parts") > 1) & (F.col("part") == F.pmod(F.xxhash64("set"), F.col("parts"))))
    rows = rows.withColumn("asked", F.col("root") != F.col("hub"))
    asks = rows.where("asked").groupBy("leader").agg(F.count("*").alias("_asks"), F.sum("size").alias("_size"))
    count = F.ceil(F.greatest(F.col("_asks") / BLOCK_SETS, F.col("_size") / BLOCK_SHINGLES)).cast("int")
    rows = _salted(rows, asks.select("leader", count.alias("_cells")), ["leader"])
    here = rows.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1))).withColumn("asked", F.lit(False))
    there = rows.where("asked").withColumn("cell", F.pmod(F.xxhash64("set"), F.col("_cells")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return here.select(*_PLACED, "size").unionByName(there.select(*_PLACED, "size"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, threshold: int = THRESHOLD,
                       block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``."""
    spark = docs.sparkSession
    context = spark.sparkContext
    docs = docs.select(key, text)
    schema = T.StructType([docs.schema[key], T.StructField("n_shingles", T.LongType()), T.StructField("set", T.LongType()), T.StructField("row", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    scanned = stored(docs.mapInArrow(trimmed(_first_scan(key, text, n)), schema), "jaccard-sets")
    slim = scanned.where(F.col("row").isNull()).select(key, "n_shingles", "set")

    counters = np.zeros((_ROWS, (1 << _COUNTERS) // _ROWS), np.uint32)
    sums = scanned.where(F.col("row").isNotNull()).select("row", "counts").repartition(_ROWS, "row").mapInArrow(trimmed(_summed), "row int, counts binary")
    for r in sums.collect():  # 4 MB, whatever the corpus
        counters[r["row"]] = np.frombuffer(r["counts"], np.uint32)
    table = context.broadcast(counters.ravel())
    total = slim.agg(F.sum("n_shingles")).first()[0] or 0
    bins = max(context.defaultParallelism, total * (110 - threshold) // 100 // BIN_SHINGLES)

    packed = docs.mapInArrow(trimmed(_prefixes(table, text, n, threshold, bins)), "bin int, keys binary, owners binary, sets binary, sizes binary")
    shared = packed.groupBy("bin").applyInArrow(_shared(threshold), "leader long, set long, size long, n long")
    shared = stored(shared.groupBy("leader", "set").agg(F.first("size").alias("size"), F.sum("n").alias("n")), "jaccard-shared")
    del packed
    table.destroy()
    least = F.expr(f"greatest(1, cast((size * {threshold} + 99) div 100 AS bigint) div {DEPTH})")
    able = shared.groupBy("set").agg(F.sum("n").alias("_n"), F.first("size").alias("size")).where(F.col("_n") >= least).select("set")
    able = stored(shared.join(able, "set"), "jaccard-able")
    members = stored(_merged(able), "jaccard-members")
    sizes = members.groupBy("leader").agg(F.count("*").alias("_sets"), F.sum("size").alias("_size"), F.max_by("set", F.struct("n", "set")).alias("_hub"))
    sizes = sizes.withColumn("parts", F.ceil(F.greatest(F.col("_sets") / block_sets, F.col("_size") / block_shingles)).cast("int"))
    special = sizes.where("parts > 1 OR _sets = 1").select("leader", "parts", "_hub", (F.col("_sets") == 1).alias("_alone"))
    blocks = _salted(members, special, ["leader"], "left").where(~F.coalesce("_alone", F.lit(False)))
    count, part = F.coalesce("parts", F.lit(1)), F.pmod(F.xxhash64("set"), F.coalesce("parts", F.lit(1))).cast("int")
    every = F.when((F.col("parts") > 1) & ((F.col("set") == F.col("leader")) | (F.col("set") == F.col("_hub"))), F.sequence(F.lit(0), count - 1)).otherwise(F.array(part))
    blocks = blocks.select("leader", F.explode(every).alias("part"), count.alias("parts"), F.lit(0).alias("cell"), F.coalesce("_hub", "leader").alias("hub"), "set", F.col("set").alias("root"), F.lit(False).alias("asked"), "size")
    blocks = stored(blocks, "jaccard-blocks")
    drop(shared, able, members)

    maps = []

    def search(rows: DataFrame, by_query: bool, name: str) -> DataFrame | None:
        """The rows' search, with their whole sets from another scan of the texts; None where there are no rows."""
        n_rows, shingles, sets = rows.agg(F.count("*"), F.sum("size"), F.approx_count_distinct("set")).first()
        if not n_rows:
            return None
        maps.append(context.broadcast(_marked(rows, "set", sets)))
        whole = docs.mapInArrow(trimmed(_whole_sets(maps[-1], text, n)), "set long, shingles binary").groupBy("set").agg(F.first("shingles").alias("shingles"))
        return stored(_dealt(rows, whole, threshold, shingles, by_query), name)

    linked = search(blocks, False, "jaccard-linked")
    if linked is not None:
        cells = stored(_cells(linked), "jaccard-cells")
        more = search(cells, True, "jaccard-more")
        links = linked if more is None else linked.unionByName(more)
        release(spark)  # the driver's parts of broadcast joins
        found = components(links.where("set != root").select(F.col("set").alias("u"), F.col("root").alias("v")), "jaccard-found")
        drop(linked, cells, *([] if more is None else [more]))
        for bits in maps:
            bits.destroy()
    else:
        found = spark.createDataFrame([], "node long, root long")
    drop(blocks)

    own = slim.where("n_shingles > 0").groupBy("set").agg(F.min(key).alias("_least"), F.count("*").alias("_copies"))
    own = own.join(found, own["set"] == found["node"], "left").select("set", F.coalesce("root", "set").alias("root"), "_least", "_copies", F.col("root").isNotNull().alias("_linked"))
    roots = own.where("_linked").groupBy("root").agg(F.min("_least").alias("_reached"))
    answer = own.where("_linked OR _copies > 1").join(roots, "root", "left").select("set", F.coalesce("_reached", "_least").alias("_component"))
    out = slim.withColumn("_set", F.when(F.col("n_shingles") > 0, F.col("set"))).join(answer.withColumnRenamed("set", "_set"), "_set", "left")
    return out.select(key, "n_shingles", F.coalesce("_component", key).alias("component_id"))
