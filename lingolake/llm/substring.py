"""Substring dedup with a log-structured fingerprint index.

A *window* is a run of ``window`` words.  Its *fingerprint* is the least hash of the ``anchor``-word shingles in it, so
neighbouring windows mostly share one, equal windows always have the same one, and the index holds about one entry
for four words.  The index is a set of immutable runs: each task sorts its fingerprints (a memory table, flushed when
it is full) and writes them by hash bucket, with one document for each fingerprint.  A new batch's runs are merged
with those of the history, bucket by bucket; what is found in two documents names the stretches whose windows are then
merged themselves, by 96 bits (64 to merge by, and 32 of an independent hash of the words to verify; an index draws its
hash functions at random, so no text can be made to collide).  Runs are compacted
into one by merging buckets and keeping the first document of each fingerprint.

A fingerprint or window that many documents have is no hot spot: each task settles its own documents among
themselves and passes on the first of them only, so a bucket gets as many entries of it as there are tasks.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .runs import MEMORY, RUN, batch_of, buckets_of, by_doc, cut_by_bucket, grouped, merged, of_documents, settle_keys, settle_run, settled, stashed
from .store import new_dir, remove, written
from .text import ByteHash, Words, drawn, pieces, rolled


class Hashes:
    """Word hashes, window fingerprints and window hashes of a column."""

    def __init__(self, window: int, anchor: int, seed: int):
        if not 0 < anchor <= window:
            raise ValueError("an anchor has 1 to window words")
        self.window, self.anchor = window, anchor
        self.first, self.second = ByteHash(seed), ByteHash(seed ^ 0x5DEECE66D)

    def fingerprints(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of each window's first word, its fingerprint, the word hashes)."""
        h = self.first.words(w.data, w.starts, w.ends)
        at = w.windows(self.window)
        if not len(at):
            return at, np.zeros(0, np.uint64), h
        order = rolled(h, self.anchor, 7)
        n = len(order) - (self.window - self.anchor)
        least = order[:n].copy()
        for j in range(1, self.window - self.anchor + 1):
            np.minimum(least, order[j : j + n], out=least)
        return at, least[at], h

    def windows(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return rolled(h, self.window, 11), (rolled(self.second.words(w.data, w.starts, w.ends), self.window, 13) >> np.uint64(32)).astype(np.uint32)


def first_pass(docs: DataFrame, hashes: tuple[int, int, int], bits: int, folder: str) -> DataFrame:
    """Rows of three kinds: 0 entries of a run (fingerprints, documents), 1 pairs of a document and a fingerprint that
    another one of the task has too, 2 a document's number of words (bucket) and hash of its words (a)."""

    def run(batches):
        make, held, n = Hashes(*hashes), [], 0

        def flush():
            rows = settled(*(np.concatenate(x) for x in zip(*held)), bits)
            held.clear()
            return batch_of(stashed([r for r in rows if r[0] != 3], folder))

        for batch in pieces(batches):
            keys = batch.column(0).to_pylist()
            w = Words(batch.column(1))
            at, fp, _ = make.fingerprints(w)
            yield batch_of([(2, int(c), k, hashlib.sha256(w.bytes_of(i)).hexdigest().encode(), None, None, None) for i, (k, c) in enumerate(zip(keys, w.counts))])
            owner = w.owner()[at]
            if len(fp):
                use = np.ones(len(fp), bool)
                use[1:] = (fp[1:] != fp[:-1]) | (owner[1:] != owner[:-1])
                use &= np.array([k is not None for k in keys])[owner]
                held.append((fp[use], np.array([k or 0 for k in keys], np.int64)[owner[use]]))
                n += int(use.sum())
            if n > MEMORY:
                yield flush()
                n = 0
        if held:
            yield flush()

    return docs.select("doc", "text").mapInArrow(run, RUN)


def later(bits: int, key: np.ndarray, check: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[list[tuple], tuple[np.ndarray, ...]]:
    """Rows with the window starts of documents after the first one that has the window; and the first ones' entries."""
    order, start = grouped(key, check, doc)
    key, check, doc, at = key[order], check[order], doc[order], at[order]
    first = np.repeat(doc[start], np.diff([*start, len(doc)])) if len(start) else doc
    hit = doc > first
    return by_doc(1, doc[hit], at[hit], bits), (key[~hit], check[~hit], doc[~hit], at[~hit])


def settle_windows(bucket: int, bits: int, *columns: np.ndarray) -> list[tuple]:
    return later(bits, *columns)[0]


def second_pass(docs: DataFrame, hashes: tuple[int, int, int], bits: int, folder: str) -> DataFrame:
    """Windows with a shared fingerprint (``docs``: doc, text, found: fingerprints): kind 0 entries of a run
    (hash, check, document, start), kind 1 starts of windows that an earlier document of the task has."""

    def run(batches):
        make, held, n = Hashes(*hashes), [], 0

        def flush():
            rows, (key, check, doc, at) = later(bits, *(np.concatenate(x) for x in zip(*held)))
            held.clear()
            rows += [(0, i, None, key[a:b], check[a:b], doc[a:b], at[a:b]) for i, a, b in cut_by_bucket(key, bits)]
            return batch_of(stashed(rows, folder))

        for batch in pieces(batches):
            keys = batch.column(0).to_pylist()
            w = Words(batch.column(1))
            at, fp, h = make.fingerprints(w)
            one, two = make.windows(w, h)
            cut = np.searchsorted(at, w.doc)
            for i, (k, found) in enumerate(zip(keys, batch.column(2).to_pylist())):
                a, b = cut[i], cut[i + 1]
                use = at[a:b][np.isin(fp[a:b], np.frombuffer(found, np.uint64))]
                if len(use):
                    held.append((one[use], two[use], np.full(len(use), k, np.int64), (use - w.doc[i]).astype(np.int32)))
                    n += len(use)
            if n > MEMORY:
                yield flush()
                n = 0
        if held:
            yield flush()

    return docs.select("doc", "text", "found").mapInArrow(run, RUN)


def settle_first_windows(bucket: int, bits: int, *columns: np.ndarray) -> list[tuple]:
    """Compaction: one document's entries for each window, the first one's."""
    return [(0, bucket, None, *later(bits, *columns)[1])]


class FingerprintIndex:
    """The runs of a corpus: of all fingerprints, and of the windows of fingerprints that two documents have had.

    A fingerprint run names one document for each fingerprint.  That is enough: while it is the only one, its windows are
    made again from its text, and once there are two, all of their windows are in a window run.  More than ``fan_in``
    runs of a kind are compacted into one.
    """

    def __init__(self, spark: SparkSession, window: int = 13, anchor: int = 8, bits: int | None = None, fan_in: int = 8):
        self.spark, self.hashes, self.fan_in = spark, (window, anchor, drawn()), fan_in
        self.bits = bits or buckets_of(spark)
        self.width = 1 << self.bits
        self.folder = new_dir(spark, "substring-index")
        self.runs: list[DataFrame] = []
        self.window_runs: list[DataFrame] = []

    def _table(self, rows: DataFrame, name: str) -> DataFrame:
        """A table in the index's own folder."""
        path = f"{self.folder}/{name}-{uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def compact(self) -> None:
        self.runs = [self._table(merged(entries(self.runs), self.bits, settle_run, self.folder), "runs")]
        if self.window_runs:
            self.window_runs = [self._table(merged(entries(self.window_runs), self.bits, settle_first_windows, self.folder), "windows")]

    def windows(self, batch: DataFrame, corpus: DataFrame, most_broadcast: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
        """Adds the batch (doc, text).  Returns the batch's words (kind 2 rows) and, as packed pairs, the starts of windows
        that also start in a document with a smaller key.  ``corpus`` has the texts of history and batch."""
        new = self._table(first_pass(batch, self.hashes, self.bits, self.folder), "runs")
        self.runs.append(new)
        both = merged(entries(self.runs), self.bits, settle_keys)
        found = self._table(both.filter("kind = 1").unionByName(new.filter("kind = 1")), "shared")
        windows = self._table(second_pass(of_documents(corpus, found, self.width, np.uint64, most_broadcast), self.hashes, self.bits, self.folder), "windows")
        self.window_runs.append(windows)
        hits = merged(entries(self.window_runs), self.bits, settle_windows)
        hits = written(hits.unionByName(windows.filter("kind = 1")), "substring-hits")
        words = written(new.filter("kind = 2").select("doc", F.col("bucket").alias("n_words"), F.col("a").cast("string").alias("sha")), "substring-words")
        if max(len(self.runs), len(self.window_runs)) > self.fan_in:
            self.compact()
        return words, hits

    def drop(self) -> None:
        """Deletes the index."""
        remove(self.spark, self.folder)
        self.runs, self.window_runs = [], []


def entries(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs).filter("kind = 0")


def removed(docs: DataFrame, window: int, with_text: bool) -> DataFrame:
    """(doc, n_removed, kept_sha, kept): the words left of documents (doc, text, found: window starts)."""

    def run(batches):
        for batch in pieces(batches):
            w = Words(batch.column(1))
            counts, kept = [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                at = np.frombuffer(found, np.int32)
                n = w.counts[i]
                edge = np.zeros(n + window + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge)[:n] > 0
                words = w.data[w.offsets[i] : w.offsets[i + 1]].tobytes().split()
                counts.append(int(gone.sum()))
                kept.append(b" ".join([x for x, g in zip(words, gone) if not g]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array([k.decode() if with_text else None for k in kept], pa.string())], names=["doc", "n_removed", "kept_sha", "kept"])

    return docs.select("doc", "text", "found").mapInArrow(run, "doc long, n_removed long, kept_sha string, kept string")


def dedup(batch: DataFrame, *, key: str = "doc_id", text: str = "text", index: FingerprintIndex | None = None, history: DataFrame | None = None, window: int = 13, anchor: int = 8, most_broadcast: int = 2_000_000, with_text: bool = True) -> DataFrame:
    """Removes each word covered by a window that also starts in a document (of batch or history) with a smaller key.

    Returns per row of the batch: key, n_words, n_removed, kept_sha256 and (if asked for) kept_text, the kept words joined
    by one space; kept_text is null where nothing was removed (the document stays as it is).  Windows are judged on the
    input.  A null text has no words; a row with a null key is kept whole and takes nothing from others.  A key stands
    for one text: rows that repeat a key should repeat the text, and come back as often.
    """
    spark = batch.sparkSession
    own, index = index is None, index or FingerprintIndex(spark, window, anchor)
    window = index.hashes[0]
    docs = batch.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    corpus = docs if history is None else docs.unionByName(history.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")))
    words, hits = index.windows(docs, corpus, most_broadcast)
    if own:
        index.drop()
    # a repeated row is worked on once for each repeat; one of the equal results is joined back
    done = removed(of_documents(docs, hits, index.width, np.int32, most_broadcast), window, with_text)
    left = done.groupBy("doc").agg(*(F.first(c).alias(c) for c in ["n_removed", "kept_sha", *(["kept"] if with_text else [])]))
    out = words.join(left, "doc", "left")
    return out.select(F.col("doc").alias(key), F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"), *([F.col("kept").alias("kept_text")] if with_text else []))
