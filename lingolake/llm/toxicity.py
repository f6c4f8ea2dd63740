"""Toxicity by a factorization machine over hashed terms.

A text is the set of its lower-cased letter runs and of their first 4 and 5 bytes (which inflected and spelled-out
variants share), hashed into ``2**bits`` places.  The machine adds to the weight of
each term the inner products of the terms' factors, so a pair such as an insult with a mention of a group has a
weight of its own.  It is fitted on a bounded sample of labelled rows (``sample`` rows of each label at most, those with
the least hash of their key), in one task, over the terms that tell something alone or in pairs; every text is then scored in a pass without a shuffle.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import ByteHash, Words, buffers, mix, pieces

#: ASCII other than letters and digits parts terms.
BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Terms(Words):
    """Letter and digit runs of a column."""

    def __init__(self, column: pa.Array):
        data, offsets = buffers(column)
        clean = np.where(BREAK[data], np.uint8(32), data)
        super().__init__(pa.Array.from_buffers(pa.large_utf8(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(clean.tobytes())]))


class Hasher:
    HEADS = (4, 5)

    def __init__(self, bits: int):
        self.shift, self.hash = np.uint64(64 - bits), ByteHash(31, lower=True)

    def __call__(self, column: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(text number, place) of the distinct places of each text, ascending; of the known ones only, if given."""
        w = Terms(column)
        owner, size = w.owner(), w.ends - w.starts
        pairs = []
        for kind in (0, *self.HEADS):
            at = slice(None) if not kind else np.flatnonzero(size > kind)
            hashes = self.hash.words(w.data, w.starts[at], w.starts[at] + kind if kind else w.ends)
            place = ((hashes ^ np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> self.shift).astype(np.int64)
            use = slice(None) if known is None else known[place]
            pairs.append(owner[at][use] << 32 | place[use])
        pairs = np.unique(np.concatenate(pairs))
        return pairs >> 32, pairs & 0xFFFFFFFF


def _chance(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _pairs(text: np.ndarray, place: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, larger place) of all pairs of places within each text, about ``most`` at a time; texts and their places ascend."""
    cut = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]])) if len(text) else np.zeros(1, np.int64)
    size = np.repeat(np.diff(cut), np.diff(cut))
    #: how many places of the text follow each one
    after = (np.repeat(cut[1:], np.diff(cut)) - np.arange(len(text)) - 1) if len(text) else size
    total, begin = np.cumsum(after), 0
    while begin < len(text):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + most, side="right")))
        n = after[begin:end]
        first = np.repeat(np.arange(begin, end), n)
        step = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        yield text[first], place[first], place[first + 1 + step]
        begin = end


def telling_pairs(text: np.ndarray, place: np.ndarray, rest: np.ndarray, spread: np.ndarray, least: float, bits: int = 22) -> np.ndarray:
    """The places in pairs whose texts' residuals (``rest``) sum to ``least`` standard deviations or more.

    Sums are kept by hash of the pair, in ``2**bits`` counters.  All pairs of a text count; the fit's sample bounds the texts.
    """

    def slot(a, b):
        return (mix(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)

    up, across = np.zeros(1 << bits), np.zeros(1 << bits)
    for t, a, b in _pairs(text, place):
        at = slot(a, b)
        # (in place: a task's memory is that of the counters and of some pairs)
        np.add.at(up, at, rest[t])
        np.add.at(across, at, spread[t])
    hit = (across >= 2.0) & (np.abs(up) >= least * np.sqrt(across))
    found = [np.zeros(0, np.int64)]
    if hit.any():
        for _, a, b in _pairs(text, place):
            use = hit[slot(a, b)]
            found.append(np.unique(np.concatenate([a[use], b[use]])))
    return np.unique(np.concatenate(found))


class Machine:
    """score = sigmoid(bias + sum of weights + half of (square of the factors' sum - sum of their squares)); terms count once."""

    def __init__(self, bits: int, bias: float, places: np.ndarray, weight: np.ndarray, factor: np.ndarray):
        self.bits, self.bias, self.places, self.weight, self.factor = bits, bias, places, weight, factor
        self.hasher = None

    @staticmethod
    def _raw(bias: float, weight: np.ndarray, factor: np.ndarray, text: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        out = bias + np.bincount(text, weight[term], n)
        if not factor.shape[1]:
            return out, np.zeros((n, 0))
        sums = np.stack([np.bincount(text, factor[term, f], n) for f in range(factor.shape[1])], 1)
        squares = np.bincount(text, (factor**2).sum(1)[term], n)
        return out + 0.5 * ((sums**2).sum(1) - squares), sums

    @classmethod
    def fit(cls, bits: int, text: np.ndarray, place: np.ndarray, label: np.ndarray, *, factors: int = 6, min_ratio: float = 20.0, min_texts: int = 20, min_score: float = 6.0, most_pairs: int = 30_000_000) -> Machine:
        """The machine of the terms that tell something, alone or in pairs.

        Alone: the log likelihood ratio (G) of a term with the label is ``min_ratio`` or more.  In pairs: of terms in ``min_texts``
        texts or more, those in pairs whose joint occurrence a model of the single terms doesn't explain (a score test of the pair,
        ``min_score`` standard deviations or more; see ``telling_pairs``), counted over texts that such a model leaves in doubt, with
        ``most_pairs`` pairs together, which bounds this step of the fit.  So two terms that are neutral alone, and toxic
        together or apart, get their factors too.
        """
        n, size = len(label), 1 << bits
        positive = float(label.sum())
        if not n or positive in (0.0, float(n)):
            share = (positive + 1) / (n + 2)
            return cls(bits, float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
        every, yes = np.bincount(place, minlength=size), np.bincount(place, label[text], size)
        no = every - yes
        share = positive / n
        with np.errstate(divide="ignore", invalid="ignore"):
            cells = ((yes, every * share), (no, every * (1 - share)), (positive - yes, (n - every) * share), (n - positive - no, (n - every) * (1 - share)))
            ratio = 2 * sum(np.where(seen > 0, seen * np.log(seen / expected), 0.0) for seen, expected in cells)
        single = np.flatnonzero(ratio >= min_ratio)
        _, _, _, chance = cls._descend(size, single, text, place, label, 0, 100)
        often = (every >= min_texts)[place]
        # texts that are explained tell nothing of pairs; of the others, those with the fewest pairs first
        held = np.bincount(text, often, n).astype(np.int64)
        told = np.abs(label - chance) >= 0.02
        order = np.argsort(np.where(told, held, 1 << 31), kind="stable")[: int(told.sum())]
        among = np.zeros(n, bool)
        among[order[: int(np.searchsorted(np.cumsum(held[order] * (held[order] - 1) // 2), most_pairs, side="right"))]] = True
        use = often & among[text]
        paired = telling_pairs(text[use], place[use], label - chance, chance * (1 - chance), min_score)
        places = np.union1d(single, paired)
        bias, weight, factor, _ = cls._descend(size, places, text, place, label, factors, 300)
        return cls(bits, bias, places, weight, factor)

    @classmethod
    def _descend(cls, size: int, places: np.ndarray, text: np.ndarray, place: np.ndarray, label: np.ndarray, factors: int, rounds: int, rate: float = 0.1, decay: float = 1e-3, seed: int = 1) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """(bias, weights, factors, chances of the texts) after adaptive gradient descent on the log loss."""
        n, positive = len(label), float(label.sum())
        number = np.full(size, -1)
        number[places] = np.arange(len(places))
        use = number[place] >= 0
        text, term = text[use], number[place[use]]
        rng = np.random.default_rng(seed)
        bias, weight, factor = float(np.log(positive / (n - positive))), np.zeros(len(places)), rng.normal(0, 0.01, (len(places), factors))
        speed = [1e-8, np.full(len(places), 1e-8), np.full(factor.shape, 1e-8)]
        for _ in range(rounds):
            raw, sums = cls._raw(bias, weight, factor, text, term, n)
            error = (_chance(raw) - label) / n
            by_term = np.bincount(term, error[text], len(places))
            pulls = [np.bincount(term, error[text] * sums[text, f], len(places)) for f in range(factors)]
            steps = [error.sum(), by_term + decay * weight / n, (np.stack(pulls, 1) if factors else factor) - factor * by_term[:, None] + decay * factor / n]
            speed = [s + g * g for s, g in zip(speed, steps)]
            bias -= rate * steps[0] / np.sqrt(speed[0])
            weight -= rate * steps[1] / np.sqrt(speed[1])
            factor -= 0.3 * rate * steps[2] / np.sqrt(speed[2])
        return float(bias), weight, factor, _chance(cls._raw(bias, weight, factor, text, term, n)[0])

    def score(self, column: pa.Array) -> np.ndarray:
        """Scores of a column's texts (nulls as empty)."""
        if self.hasher is None:
            self.hasher = Hasher(self.bits)
            self.number = np.full(1 << self.bits, -1)
            self.number[self.places] = np.arange(len(self.places))
            self.known = self.number >= 0
        text, place = self.hasher(column, self.known)
        raw, _ = self._raw(self.bias, self.weight, self.factor, text, self.number[place], len(column))
        return _chance(raw)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, bits=self.bits, bias=self.bias, places=self.places, weight=self.weight.astype(np.float32), factor=self.factor.astype(np.float32))
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Machine:
        x = np.load(io.BytesIO(raw))
        return cls(int(x["bits"]), float(x["bias"]), x["places"], x["weight"].astype(float), x["factor"].astype(float))


def held_out(key: Column) -> Column:
    """Rows whose label is not learnt from: crc32 of the key as text, modulo 3, is 1 (a null key: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(3)) == 1


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 6000, bits: int = 18) -> bytes:
    """A fitted machine.  At most ``sample`` rows of each label are learnt from, which bounds the one task that fits.

    Rows that are held out, and null keys or labels, are not used.  A key labelled twice counts as toxic if once so.
    Without labels of both kinds every text gets the smoothed share of the label.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(F.max(label).cast("int").alias("__label"))
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("__label") == value).orderBy(F.xxhash64(key), key).limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # 2 * sample rows of two numbers: a proven bound
    rows = docs.select(F.col(key), F.col(text).alias("__text")).join(F.broadcast(chosen), key).select("__label", "__text")

    def places(batches):
        hasher = Hasher(bits)
        for batch in pieces(batches, "__text"):
            owner, place = hasher(batch.column(1))
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(place, pa.int32()))], names=["label", "places"])

    def fit(batches):
        labels, sizes, flat = [], [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            lists = batch.column(1)
            sizes += [len(x) for x in lists]
            flat.append(lists.flatten().to_numpy(zero_copy_only=False))
        size = np.array(sizes, np.int64)
        machine = Machine.fit(bits, np.repeat(np.arange(len(size)), size), np.concatenate(flat).astype(np.int64) if flat else np.zeros(0, np.int64), np.array(labels, float))
        yield pa.RecordBatch.from_pydict({"model": [machine.dump()]})

    shares = rows.mapInArrow(places, "label int, places array<int>").repartition(1)
    return bytes(shares.mapInArrow(fit, "model binary").first()["model"])


def score(docs: DataFrame, model: bytes, *, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """The ``keep`` columns (all by default) and the score of each text, 0 to 1; a null text scores as an empty one.  No shuffle."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    source = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), f"`{out}` double"])

    def run(batches):
        machine = Machine.load(model)
        for batch in pieces(batches, "__text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(machine.score(batch.column(batch.num_columns - 1)))], names=[*keep, out])

    return source.mapInArrow(run, schema)
