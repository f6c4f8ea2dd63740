"""Near-duplicate detection: b-bit MinHash signatures, a multi-index Hamming join, exact confirmation.

A text's set is that of its distinct shingles.  Texts with equal sets are one class.  Each class has a signature of
``chunks * width`` symbols of 16 bits (one min-hash each).  Two signatures that differ in at most ``2 * chunks - 1``
symbols differ by at most one in some chunk (pigeonhole); so each chunk is indexed once for each of its symbols
left out, and all pairs within that distance share a key.  With 14 chunks of 6 a pair at similarity 0.85 shares no key
with probability 3e-8, one at 0.80 with 4e-7.

Keys meet by runs (see ``runs``).  First each document is compared with the first one of each of its keys, and what that
links is merged.  For keys whose documents are still in several components, each document is compared with the most
central one of its block of documents, and what that links is merged too.  For keys that are mixed even then, all
pairs across components are compared, in blocks.  So no pair that shares a key is left out, while a group of copies
costs a few comparisons a member.

Comparisons are by parity sketches first: each shingle flips one bit, so two sketches differ in no more bits than the
sets differ in shingles, and a pair with more can't be similar enough.  The rest is confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .runs import MEMORY, RUN, batch_of, buckets_of, merged, settle_keys, settled, stashed
from .store import new_dir, remove, written
from .text import ByteHash, Words, _random, drawn, mix, pieces, rolled

CHUNKS, WIDTH = 14, 6
#: Documents in a block when the pairs of a key are compared.
BLOCK = 512


class Shingles:
    """Hashes of the distinct shingles of each text of a column: ``values`` ascend within a text, ``doc`` are offsets."""

    def __init__(self, column: pa.Array, k: int, hashing: ByteHash):
        w = Words(column)
        h = hashing.words(w.data, w.starts, w.ends)
        run = rolled(h, k, 17)
        out = []
        for i, n in enumerate(w.counts.tolist()):
            a = w.doc[i]
            if n >= k:
                out.append(np.unique(run[a : a + n - k + 1]))
            elif n:
                # the whole sequence is its one shingle; its length tells it from the others
                out.append(rolled(h[a : a + n], n, 19 + n))
            else:
                out.append(np.zeros(0, np.uint64))
        self.sizes = np.array([len(x) for x in out], np.int64)
        self.doc = np.concatenate([[0], np.cumsum(self.sizes)])
        self.values = np.concatenate(out) if out else np.zeros(0, np.uint64)


def signatures(s: Shingles, n: int) -> np.ndarray:
    """n symbols of each text with shingles (zeros for the others)."""
    out = np.zeros((len(s.sizes), n), np.uint16)
    use = np.flatnonzero(s.sizes)
    if len(use):
        starts = s.doc[use]
        for j, a in enumerate(_random(23, n) | np.uint64(1)):
            t = s.values * a
            t ^= t >> np.uint64(32)
            out[use, j] = (mix(np.minimum.reduceat(t, starts)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def keys(signature: np.ndarray, chunks: int, width: int) -> np.ndarray:
    """(texts, chunks * width) keys: for each chunk and each symbol left out, a hash of the chunk's other symbols."""
    x = signature.reshape(len(signature), chunks, width).astype(np.uint64)
    terms = x * (_random(29, width) | np.uint64(1)) + _random(31, width)
    terms = mix(terms)
    whole = terms.sum(2, dtype=np.uint64)
    slot = mix(np.arange(chunks * width, dtype=np.uint64)).reshape(chunks, width)
    return mix((whole[:, :, None] - terms) ^ slot[None]).reshape(len(signature), -1)


def sketch(values: np.ndarray) -> bytes:
    """Parity sketch of a set of hashes, with two bits for each at least (a power of two of bits, at least 256)."""
    bits = 256
    while bits < 2 * len(values):
        bits *= 2
    flips = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def folded(x: np.ndarray) -> np.ndarray:
    """Sketches (rows of bytes) of half the bits."""
    half = x.shape[-1] // 2
    return x[..., :half] ^ x[..., half:]


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, at the smaller one's size."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = folded(a)
    while len(b) > len(a):
        b = folded(b)
    return int(np.bitwise_count(a ^ b).sum())


def may_link(differ, na, nb, percent: int):
    """Whether sets of these sizes that differ in so many shingles or more can be similar enough (exact, in integers)."""
    return differ * (100 + percent) <= (na + nb) * (100 - percent)


def _signed(docs: DataFrame, k: int, n: int, seed: int) -> DataFrame:
    """(doc, n, f, g, sig, odd) of (doc, text): size of the set, two fingerprints of it, its signature and parity sketch."""

    def run(batches):
        hashing = ByteHash(seed, lower=True)
        for batch in pieces(batches):
            s = Shingles(batch.column(1), k, hashing)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(s.values ^ np.uint64(salt)))]) for salt in (1, 2)]
            f, g = ((x[s.doc[1:]] - x[s.doc[:-1]]).view(np.int64) for x in sums)
            sig = signatures(s, n)
            odd = [sketch(s.values[a:b]) for a, b in zip(s.doc, s.doc[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.sizes), pa.array(f), pa.array(g), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(odd, pa.binary())], names=["doc", "n", "f", "g", "sig", "odd"])

    return docs.mapInArrow(run, "doc long, n long, f long, g long, sig binary, odd binary")


def _key_runs(classes: DataFrame, chunks: int, width: int, bits: int, folder: str) -> DataFrame:
    """Kinds 0, 1 and 3 (see ``runs.settled``) of the keys of (doc, sig) rows."""

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            found = keys(sig, chunks, width)
            held.append((found.ravel(), np.repeat(batch.column(0).to_numpy(), found.shape[1])))
            n += found.size
            if n > MEMORY:
                yield batch_of(stashed(settled(*(np.concatenate(x) for x in zip(*held)), bits), folder))
                held, n = [], 0
        if held:
            yield batch_of(stashed(settled(*(np.concatenate(x) for x in zip(*held)), bits), folder))

    return classes.select("doc", "sig").mapInArrow(run, RUN)


def _unpacked(rows: DataFrame, name: str) -> DataFrame:
    """(doc, name) of packed pairs."""

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["doc", name])

    return rows.select("a", "b").mapInArrow(run, f"doc long, `{name}` long")


def _plausible(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches don't rule out."""
    rows = pairs.join(facts.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa")), "a").join(facts.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("ob")), "b")
    rows = rows.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b", "na", "nb", "oa", "ob")

    def run(batches):
        for batch in batches:
            na, nb, x, y = (batch.column(i).to_pylist() for i in (2, 3, 4, 5))
            yield batch.select([0, 1]).filter(pa.array([may_link(differing(p, q), m, n, percent) for m, n, p, q in zip(na, nb, x, y)], pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, k: int, seed: int) -> DataFrame:
    """The rows (doc, text, ...) with the text's shingles in place of it, as ``shingles``."""
    others = [c for c in docs.columns if c != "text"]
    source = docs.select(*others, "text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), "shingles array<long>"])

    def run(batches):
        hashing = ByteHash(seed, lower=True)
        for batch in pieces(batches):
            s = Shingles(batch.column(batch.num_columns - 1), k, hashing)
            lists = pa.ListArray.from_arrays(pa.array(s.doc, pa.int32()), pa.array(s.values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*others, "shingles"])

    return source.mapInArrow(run, schema)


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, most_broadcast: int, seed: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full shingle sets."""
    narrow = docs
    names = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    if names.count() <= most_broadcast:
        narrow = docs.join(F.broadcast(names), "doc", "left_semi")
    left = _sets(narrow.join(pairs.select(F.col("b").alias("doc"), "a"), "doc"), k, seed).select(F.col("doc").alias("b"), "a", F.col("shingles").alias("sb"))
    right = _sets(narrow.join(pairs.select(F.col("a").alias("doc")).distinct(), "doc", "left_semi"), k, seed).select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - both
    return left.join(right, "a").filter(both * 100 >= union * percent).select("a", "b").distinct()


class Block:
    """Documents of one key (rows: doc, component, n, sig, odd), and which pairs of them to look at."""

    def __init__(self, held: list[dict], percent: int, chunks: int):
        self.doc, self.part, self.n = (np.array([r[c] for r in held]) for c in ("doc", "component", "n"))
        self.sig = np.frombuffer(b"".join(r["sig"] for r in held), np.uint16).reshape(len(held), chunks, -1)
        self.percent = percent
        #: by bytes of a sketch: which documents have such ones, these, and these at half the bits
        self.odd, self.bytes = {}, np.array([len(r["odd"]) for r in held])
        for size in np.unique(self.bytes).tolist():
            at = np.flatnonzero(self.bytes == size)
            x = np.frombuffer(b"".join(held[i]["odd"] for i in at), np.uint8).reshape(len(at), size)
            self.odd[size] = at, x, folded(x)
        self.place = np.zeros(len(held), np.int64)
        for at, _, _ in self.odd.values():
            self.place[at] = np.arange(len(at))

    def central(self) -> int:
        """The document whose symbols agree with most others'."""
        flat = self.sig.reshape(len(self.doc), -1)
        return int(np.argmax([(flat == x).sum() for x in flat]))

    def linkable(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` in another component than x that sizes and sketches don't rule out."""
        n = self.n[others]
        others = others[(self.part[others] != self.part[x]) & (np.minimum(n, self.n[x]) * 100 >= np.maximum(n, self.n[x]) * self.percent)]
        out, size = [], int(self.bytes[x])
        # sizes that near give sketches of the same, half or double the bits
        for other in (size // 2, size, size * 2):
            if other in self.odd:
                at = others[self.bytes[others] == other]
                _, full, half = self.odd[other]
                mine = self.odd[size][2 if other < size else 1][self.place[x]]
                differ = np.bitwise_count((half if other > size else full)[self.place[at]] ^ mine).sum(1, dtype=np.int64)
                out.append(at[may_link(differ, self.n[at], self.n[x], self.percent)])
        return np.concatenate(out) if out else others[:0]

    def first_met(self, x: int, others: np.ndarray, key: int, all_keys: np.ndarray) -> np.ndarray:
        """Those of ``others`` with which x shares no key before this one (so that a pair is told once)."""
        agree = self.sig[others] == self.sig[x]
        chunk = np.argmax(agree.sum(2) >= agree.shape[2] - 1, axis=1)
        left_out = np.argmin(agree[np.arange(len(others)), chunk], axis=1)
        return others[all_keys[x, chunk * agree.shape[2] + left_out] == np.uint64(key & (1 << 64) - 1)]


def _mixed(found: DataFrame, labels: DataFrame, facts: DataFrame, percent: int, chunks: int, width: int, central: bool) -> DataFrame:
    """Pairs (a, b), of different components, that share a key of ``found`` (doc, key) and aren't ruled out.

    ``central``: only those with the most central document of a block.  A key's documents are dealt to blocks of about
    ``BLOCK``, and (but for ``central``) each two blocks of a key are compared by one task at a time, so what it holds
    is bounded.
    """
    rows = written(found.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc")), "neardup-keys")
    size = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n_docs")).filter("lo <> hi")
    rows = rows.join(written(size.select("key", F.ceil(F.col("n_docs") / BLOCK).cast("int").alias("blocks")), "neardup-mixed"), "key")
    mine = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    rows = rows.withColumn("mine", mine)
    rows = rows.withColumn("other", F.col("mine") if central else F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.join(facts.select("doc", "n", "sig", "odd"), "doc")
    rows = rows.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "doc", "component", "n", "sig", "odd")

    def compare(at, held):
        block, out = Block(held, percent, chunks), []
        every = np.arange(len(held))
        if central:
            x = block.central()
            out += [(x, int(y)) for y in block.linkable(x, every)]
        else:
            mine = np.array([r["mine"] for r in held])
            all_keys = keys(block.sig.reshape(len(held), -1), chunks, width)
            for x in range(len(held) - 1):
                others = every[x + 1 :]
                if at[1] != at[2]:
                    others = others[mine[others] != mine[x]]
                others = block.linkable(x, others)
                if len(others):
                    out += [(x, int(y)) for y in block.first_met(x, others, at[0], all_keys)]
        pairs = [sorted((int(block.doc[x]), int(block.doc[y]))) for x, y in out]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    def run(batches):
        at, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["key"], row["i"], row["j"]) != at:
                    if len({r["component"] for r in held}) > 1:
                        yield compare(at, held)
                    at, held = (row["key"], row["i"], row["j"]), []
                held.append(row)
        if len({r["component"] for r in held}) > 1:
            yield compare(at, held)

    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long").distinct()


def classes_of(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 85, chunks: int = CHUNKS, width: int = WIDTH, most_broadcast: int = 2_000_000) -> DataFrame:
    """Per row: key, n_shingles, component_id (least key that links lead to, its own included), kept (key = component_id).

    A-Z count as a-z.  A text with fewer words than a shingle has its whole sequence as one shingle; one without
    words (or a null) has none and is linked with nothing.  A row with a null key is linked with nothing, has a null
    component and is kept.  Rows that repeat a key should repeat the text, and come back as often.
    """
    spark, n = docs.sparkSession, chunks * width
    # shingles are told apart by 64 bits of a function that is drawn for this call
    seed = drawn()
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    facts = written(_signed(rows, shingle, n, seed), "neardup-signatures")
    alike = ["n", "f", "g"]
    classes = written(facts.filter("n > 0 AND doc IS NOT NULL").groupBy(*alike).agg(F.min("doc").alias("doc"), F.first("sig").alias("sig"), F.first("odd").alias("odd")), "neardup-classes")
    bits = buckets_of(spark)
    folder = new_dir(spark, "neardup-files")
    runs = written(_key_runs(classes, chunks, width, bits, folder), "neardup-runs")
    met = written(merged(runs.filter("kind = 0"), bits, settle_keys), "neardup-met")
    remove(spark, folder)
    both = met.unionByName(runs.filter("kind <> 0"))
    known = rows.filter("doc IS NOT NULL")

    stars = _unpacked(both.filter("kind = 3"), "first").select(F.least("doc", "first").alias("a"), F.greatest("doc", "first").alias("b")).distinct()
    seen = written(_plausible(stars, classes, percent), "neardup-pairs")
    links = written(confirmed(seen, known, shingle, percent, most_broadcast, seed), "neardup-links")
    labels = components(links)
    found = _unpacked(both.filter("kind = 1"), "key")
    for central in (True, False):
        more = written(_mixed(found, labels, classes, percent, chunks, width, central).join(seen, ["a", "b"], "left_anti"), "neardup-pairs")
        if more.limit(1).count():
            seen = seen.unionByName(more)
            links = links.unionByName(written(confirmed(more, known, shingle, percent, most_broadcast, seed), "neardup-links"))
            labels = components(links)
    classes = written(classes.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(*alike, F.coalesce("component", "doc").alias("component")), "neardup-components")
    own = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    out = facts.select("doc", *alike).join(classes, alike, "left")
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"), (F.coalesce("doc", F.lit(0)) == F.coalesce(own, F.lit(0))).alias("kept"))
