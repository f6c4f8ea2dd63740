"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity.

Words are lower-cased runs of letters and digits.  Window sizes form a geometric series; an item is fingerprinted by
windows of one size, so many and so placed that a passage which lacks some of the words of each of them is less similar
than the threshold (see ``places``).  Every window of those sizes of every text is fingerprinted too (64 bits, a majority vote of its words' hash bits).  Fingerprints are cut into ``BLOCKS``
blocks; those within ``radius`` bits agree in some block but for ``radius // BLOCKS`` bits (pigeonhole), so a table by
block value of all values within that many bits finds every one of them.  What is within the radius is
verified: the weighted Jaccard similarity of the five-word shingles of the item and of the text's stretch of the item's
length, a shingle weighing as much as its words have bytes.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import NewFile, new_dir, opened, written
from .text import ByteHash, pieces, rolled
from .toxicity import Terms

BITS, BLOCKS = 64, 4
WIDTH = BITS // BLOCKS
#: Ratio of window sizes.
RATIO = 1.25
#: Bytes of benchmark text that one pass over the documents takes along.
PASS_BYTES = 16 << 20


def sizes(longest: int) -> list[int]:
    out = [1]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return [s for s in out if s <= longest]


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of numbers by bit planes, the lowest first (lane i of plane j is bit j of lane i's number)."""
    out, carry = [], None
    for i in range(max(len(a), len(b))):
        terms = [x[i] for x in (a, b) if i < len(x)]
        if len(terms) == 1:
            terms, carry = [terms[0], carry] if carry is not None else terms, None
            if len(terms) == 1:
                out.append(terms[0])
                continue
        x, y = terms
        one = x ^ y
        if carry is None:
            out.append(one)
            carry = x & y
        else:
            out.append(one ^ carry)
            carry = (x & y) | (one & carry)
    return [*out, carry] if carry is not None else out


class Votes:
    """Fingerprints of the windows of a word sequence: bit i is set where more than half of a window's hashes have it set.

    All 64 bits are counted at once, by planes: plane j holds bit j of each bit's count.  Windows of 2, 4, 8, ... words are
    sums of two of half the size, other sizes are sums of those, so a window takes a few operations however long it is.
    """

    def __init__(self, hashes: np.ndarray):
        self.n, self.doubled = len(hashes), [[hashes]]

    def __call__(self, size: int) -> np.ndarray:
        n = self.n - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        while 1 << len(self.doubled) <= size:
            half, x = 1 << len(self.doubled) - 1, self.doubled[-1]
            # (a count of 2 ** k takes k + 1 planes)
            self.doubled.append(_added([p[:-half] for p in x], [p[half:] for p in x]))
        total, at = [], 0
        for k in reversed(range(size.bit_length())):
            if size >> k & 1:
                total = _added(total, [p[at : at + n] for p in self.doubled[k]])[: size.bit_length()]
                at += 1 << k
        above, equal = np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64)
        for j in reversed(range(len(total))):
            if size // 2 >> j & 1:
                equal &= total[j]
            else:
                above |= equal & total[j]
                equal &= ~total[j]
        return above


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def neighbours(value: int, errors: int) -> list[int]:
    """Block values that differ in at most so many bits."""
    out = [value]
    for n in range(1, errors + 1):
        for at in combinations(range(WIDTH), n):
            out.append(value ^ sum(1 << i for i in at))
    return out


@dataclass
class Item:
    key: int
    #: The distinct shingles, how often each is there, and what it weighs.
    shingles: np.ndarray
    counts: np.ndarray
    weights: np.ndarray
    n: int
    total: int
    #: How far the place of an undamaged window can lie from a place that is similar enough, in words, and what it has in common at least.
    reach: int
    least: float


class Table:
    """The fingerprints of one window size, by block."""

    def __init__(self, size: int, prints: list[tuple[int, int, int]], radius: int):
        #: (fingerprint, item, how far its window's first word is from the item's first)
        self.size, self.radius = size, radius
        self.prints = np.array([p[0] for p in prints], np.uint64)
        self.items = np.array([p[1] for p in prints])
        self.shift = np.array([p[2] for p in prints])
        self.first, self.held = [], []
        for b in range(BLOCKS):
            lists: dict[int, list[int]] = {}
            for i, p in enumerate(self.prints.tolist()):
                for v in neighbours(p >> b * WIDTH & (1 << WIDTH) - 1, radius // BLOCKS):
                    lists.setdefault(v, []).append(i)
            count = np.zeros((1 << WIDTH) + 1, np.int64)
            for v, held in lists.items():
                count[v + 1] = len(held)
            self.first.append(np.cumsum(count))
            self.held.append(np.array([i for v in sorted(lists) for i in lists[v]], np.int64))
        self.some = [np.diff(f) > 0 for f in self.first]

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, entry) of all pairs within the radius (a pair may come more than once)."""
        at, entry = [], []
        # blocks are of 16 bits: four numbers of a fingerprint
        by_block = prints.astype("<u8").view("<u2").reshape(-1, BLOCKS)
        for b in range(BLOCKS):
            block = by_block[:, b]
            use = np.flatnonzero(self.some[b][block])
            # a bounded number of windows at a time
            for part in np.array_split(use, max(1, len(use) // 100_000 + 1)):
                value = block[part].astype(np.int64)
                begin = self.first[b][value]
                n = self.first[b][value + 1] - begin
                ends = np.cumsum(n)
                if not len(ends):
                    continue
                found = self.held[b][np.repeat(begin - ends + n, n) + np.arange(ends[-1])]
                window = np.repeat(part, n)
                good = distance(prints[window], self.prints[found]) <= self.radius
                at.append(window[good])
                entry.append(found[good])
        return (np.concatenate(at), np.concatenate(entry)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def shingled(h: np.ndarray, length: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, weight) of each shingle of a word sequence; a sequence shorter than a shingle is one itself."""
    k = min(k, len(h)) or 1
    total = np.concatenate([[0], np.cumsum(length)])
    return rolled(h, k, 41 + k), (total[k:] - total[:-k])[: max(0, len(h) - k + 1)]


def places(h: np.ndarray, weights: np.ndarray, k: int, spare: float, series: list[int]) -> tuple[int, list[int]]:
    """(size, starts) of the windows by which an item is found, given its words, the weights of its shingles and the weight that may be missing.

    A passage with the similarity holds all shingles of the item but for ``spare``.  To break a window's words apart
    between two of them costs all shingles across that gap, nothing if the words before it are in the item again.  Windows
    so far apart that no shingle counts twice cost the sum of their cheapest gaps; the largest size of the series is taken
    for which that is more than ``spare``.  If there is none, single shingles that weigh more than it together are taken.
    """
    n, count = len(h), len(weights)
    if n <= k:
        return n, [0]
    total = np.concatenate([[0], np.cumsum(weights)])
    gap = np.arange(n - 1)
    cost = total[np.minimum(gap + 1, count)] - total[np.minimum(np.maximum(gap - k + 2, 0), count)]
    if k > 1:
        before = rolled(h, k - 1, 43 + k)
        _, at, seen = np.unique(before, return_inverse=True, return_counts=True)
        cost[k - 2 :][seen[at[: n - k + 1]] > 1] = 0
    apart = k - 3
    for size in [s for s in reversed(series) if k < s <= n]:
        cheapest = np.lib.stride_tricks.sliding_window_view(cost, size - 1).min(axis=1)
        most = (n + apart) // (size + apart) if size + apart > 0 and apart >= 0 else 1
        for number in range(1, most + 1) if most <= 8 else (most,):
            room = n - number * size - (number - 1) * apart
            edge = min(k - 2, room // 2) if number > 1 else room // 2
            starts = [edge + i * (size + apart) + (room - 2 * edge) * i // max(1, number - 1) for i in range(number)]
            if cheapest[starts].sum() > spare:
                return size, starts
    _, first = np.unique(rolled(h, k, 41 + k), return_index=True)
    first = first[np.argsort(-weights[first], kind="stable")]
    return k, sorted(first[: int(np.searchsorted(np.cumsum(weights[first]), spare, side="right")) + 1].tolist())


def similarity(item: Item, shingles: np.ndarray, weights: np.ndarray) -> tuple[float, int]:
    """Weighted Jaccard similarity of multisets of shingles, and the weight that they have in common."""
    at = np.minimum(np.searchsorted(item.shingles, shingles), len(item.shingles) - 1)
    seen = np.bincount(at[item.shingles[at] == shingles], minlength=len(item.counts))
    both = int((np.minimum(item.counts, seen) * item.weights).sum())
    union = item.total + int(weights.sum()) - both
    return (both / union if union else 0.0), both


class Searcher:
    """Finds the items of a benchmark in texts."""

    def __init__(self, items: list[tuple[int, str | None]], radius: int, shingle: int, threshold: float):
        self.hash, self.k, self.threshold = ByteHash(505, lower=True), shingle, threshold
        self.items: list[Item] = []
        by_size: dict[int, list] = {}
        texts = pa.array([t for _, t in items], pa.string())
        w = Terms(texts)
        h, length = self.hash.words(w.data, w.starts, w.ends), w.ends - w.starts
        series = sizes(max([1, *w.counts.tolist()]))
        for i, (key, _) in enumerate(items):
            a, b = w.doc[i], w.doc[i + 1]
            if b == a:
                continue
            s, weight = shingled(h[a:b], length[a:b], self.k)
            spare = (1 - threshold) * int(weight.sum()) + 1e-6
            size, starts = places(h[a:b], weight, self.k, spare, series)
            prints = Votes(h[a:b])(size)
            number = len(self.items)
            # a place so many words away misses at least as many shingles, and has lost as many at most
            order = np.sort(weight)
            reach = int(np.searchsorted(np.cumsum(order), spare, side="right"))
            total = int(weight.sum())
            distinct, first, count = np.unique(s, return_index=True, return_counts=True)
            self.items.append(Item(key, distinct, count, weight[first], int(b - a), total, reach, total - spare - int(order[len(order) - reach :].sum())))
            by_size.setdefault(size, []).extend((int(prints[d]), number, d) for d in starts)
        self.tables = [Table(size, prints, radius) for size, prints in sorted(by_size.items())]

    def __call__(self, column: pa.Array) -> list[tuple[int, int, int, int, float]]:
        """(text number, item key, first word, words, similarity): the best place of each item in each text, if it is similar enough."""
        w = Terms(column)
        h, length = self.hash.words(w.data, w.starts, w.ends), w.ends - w.starts
        votes, owner = Votes(h), w.owner()
        tried: set[tuple[int, int, int]] = set()
        for table in self.tables:
            prints = votes(table.size)
            if not len(prints):
                continue
            at, entry = table.within(prints)
            inside = owner[at] == owner[at + table.size - 1] if len(at) else np.zeros(0, bool)
            for i, e in zip(at[inside].tolist(), entry[inside].tolist()):
                tried.add((int(owner[i]), int(table.items[e]), int(i - w.doc[owner[i]] - table.shift[e])))
        rated: dict[tuple[int, int, int], tuple[float, int]] = {}
        whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def rate(doc: int, number: int, start: int) -> tuple[float, int]:
            if (doc, number, start) not in rated:
                item, a, n = self.items[number], w.doc[doc], w.counts[doc]
                lo, hi = max(0, start), min(n, start + item.n)
                if hi - lo < self.k:
                    rated[doc, number, start] = similarity(item, *shingled(h[a + lo : a + hi], length[a + lo : a + hi], self.k)) if hi > lo else (0.0, 0)
                else:
                    if doc not in whole:
                        whole.clear()
                        whole[doc] = shingled(h[a : a + n], length[a : a + n], self.k)
                    rated[doc, number, start] = similarity(item, *(x[lo : hi - self.k + 1] for x in whole[doc]))
            return rated[doc, number, start]

        # from each candidate to the best place that it can be part of
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for doc, number, start in sorted(tried):
            found, both = rate(doc, number, start)
            if both < self.items[number].least or best.get((doc, number), (0.0,))[0] == 1.0:
                continue
            if found < 1.0:
                reach = self.items[number].reach
                start = max(range(start - reach, start + reach + 1), key=lambda s: (rate(doc, number, s)[0], -abs(s - start)))
                found = rate(doc, number, start)[0]
            if found >= self.threshold and found > best.get((doc, number), (0.0,))[0]:
                n = w.counts[doc]
                best[doc, number] = found, max(0, start), int(min(n, start + self.items[number].n) - max(0, start))
        return [(doc, self.items[number].key, start, n, found) for (doc, number), (found, start, n) in sorted(best.items())]


def matches(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", radius: int = 7, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """A row (doc key, item key, start_word, n_words, similarity) for each row of ``docs`` and item found in it.

    Texts and items without words (or null) match nothing.  An item shorter than a shingle is one shingle.  Repeated
    documents come as often as they are there; repeated item keys as often as they match.  The benchmark is dealt to parts
    of about ``PASS_BYTES`` of text, and each part's tables are built by one task and kept as a file in the shared folder;
    the driver has the files' names only.  A pass over the documents takes one part along, so a large benchmark takes more
    passes and not more memory; no shuffle of the documents.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = total // PASS_BYTES + 1
    schema = f"`{key}` long, `{item_key}` long, start_word long, n_words long, similarity double"
    out = None
    for uri in [r["uri"] for r in _built(items, passes, radius, shingle, threshold).collect()]:

        def run(batches, uri=uri):
            search = _loaded(uri)
            for batch in pieces(batches, most=1 << 20):
                keys = batch.column(0).to_pylist()
                found = [(keys[d], *rest) for d, *rest in search(batch.column(1))]
                cols = list(zip(*found)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.float64())], names=[key, item_key, "start_word", "n_words", "similarity"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _built(items: DataFrame, parts: int, radius: int, shingle: int, threshold: float) -> DataFrame:
    """(uri): a file with the searcher of each part of the items; one row a part, so their number is that of the passes."""
    folder = new_dir(items.sparkSession, "decontaminate-tables")

    def run(batches):
        held, at = [], None

        def told():
            file = NewFile(folder, "part.tables")
            file.write(pickle.dumps(Searcher(held, radius, shingle, threshold), pickle.HIGHEST_PROTOCOL))
            return pa.RecordBatch.from_pydict({"uri": [file.close()]})

        for batch in batches:
            for part, item, text in zip(*(c.to_pylist() for c in batch.columns)):
                if part != at and held:
                    yield told()
                    held = []
                at = part
                held.append((item, text))
        if held:
            yield told()

    dealt = items.select(F.pmod(F.xxhash64("item", "text"), F.lit(parts)).alias("part"), "item", "text")
    return written(dealt.repartition(parts, "part").sortWithinPartitions("part", "item", "text").mapInArrow(run, "uri string"), "decontaminate-parts")


#: The searcher that this Python worker loaded last, by its file.
LOADED: dict[str, Searcher] = {}


def _loaded(uri: str) -> Searcher:
    if uri not in LOADED:
        LOADED.clear()
        with opened(uri) as f:
            LOADED[uri] = pickle.loads(f.read())
    return LOADED[uri]


def clean(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` in which no item of the benchmark was found (rows with a null key stay)."""
    found = written(matches(docs, benchmark, key=key, **how).select(key).filter(F.col(key).isNotNull()).distinct(), "decontaminate")
    return docs.join(found, key, "left_anti")
