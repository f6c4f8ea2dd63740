"""Sorted runs of (key, document) entries by hash bucket, and their merging: how equal keys of many documents meet.

A task sorts what it has (a memory table) and settles its own documents among themselves; for each key it passes on
one document only.  So a key that a third of all documents have brings a bucket one entry a task, not one a document.
Runs are immutable files in the shared folder, with a segment for each bucket: keys as differences, all columns by
byte planes, compressed.  What is shuffled are the segments' places; a merging task reads its bucket's segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .store import NewFile, opened, written
from .text import mix

#: Entries that a task holds before it flushes a run.
MEMORY = 600_000
#: What kinds of rows there are and what their columns hold is said where they are made.
RUN = "kind int, bucket int, doc long, a binary, b binary, c binary, d binary"


def squeeze(x: np.ndarray, ascending: bool) -> bytes:
    """A column of a segment; ascending ones as differences."""
    kind = x.dtype.str.encode().ljust(4)
    if ascending and len(x):
        x = np.concatenate([x[:1], x[1:] - x[:-1]])
    return kind + bytes([ascending]) + len(x).to_bytes(8, "little") + (pa.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes(), "zstd", asbytes=True) if len(x) else b"")


def unsqueeze(raw: bytes) -> np.ndarray:
    kind, n = np.dtype(raw[:4].decode().strip()), int.from_bytes(raw[5:13], "little")
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(raw[13:], n * kind.itemsize, "zstd", asbytes=True), np.uint8)
    x = np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if raw[4] else x


def stashed(rows: list[tuple], folder: str) -> list[tuple]:
    """The rows, with the columns of kind 0 rows in one new run file, and their places in the rows instead."""
    out, file = [], None
    for row in rows:
        if row[0] == 0:
            file = file or NewFile(folder, "run.bin")
            parts = [squeeze(x, not i) for i, x in enumerate(row[3:]) if x is not None]
            row = (0, row[1], None, pack(np.array([file.size, *map(len, parts)], np.int64)), file.uri.encode(), None, None)
            file.write(b"".join(parts))
        out.append(row)
    if file:
        file.close()
    return out


def loaded(row: dict, files: dict) -> list[np.ndarray]:
    """The columns that a place stands for."""
    uri = row["b"].decode()
    if uri not in files:
        files[uri] = opened(uri)
    at, *sizes = np.frombuffer(row["a"], np.int64).tolist()
    raw, out, i = files[uri].read_at(sum(sizes), at), [], 0
    for size in sizes:
        out.append(unsqueeze(raw[i : i + size]))
        i += size
    return out


def pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4)
    cols = list(zip(*rows)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["kind", "bucket", "doc", "a", "b", "c", "d"])


def by_doc(kind: int, doc: np.ndarray, values: np.ndarray, bits: int) -> list[tuple]:
    """Rows of pairs of a document and a value, packed by a bucket of the document (a: documents, b: values); see ``gathered``."""
    bucket = mix(doc.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange((1 << bits) + 1).astype(np.uint64))
    return [(kind, i, None, pack(doc[order[x:y]]), pack(values[order[x:y]]), None, None) for i, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]


def gathered(rows: DataFrame, width: int, kind: type) -> DataFrame:
    """(doc, found): one row for each document of packed pairs, with its distinct values (numbers of the kind) as bytes."""

    def run(batches):
        bucket, held = None, []

        def told():
            doc, values = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((values, doc))
            doc, values = doc[order], values[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
            doc, values = doc[new], values[new]
            cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
            for i in range(0, len(cut) - 1, 1000):
                part = cut[i : i + 1001]
                yield pa.RecordBatch.from_arrays([pa.array(doc[part[:-1]]), pa.array([pack(values[x:y]) for x, y in zip(part, part[1:])], pa.binary())], names=["doc", "found"])

        for batch in batches:
            for i, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if i != bucket and held:
                    yield from told()
                bucket = i
                held.append((np.frombuffer(a, np.int64), np.frombuffer(b, kind)))
        if held:
            yield from told()

    return rows.select("bucket", "a", "b").repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc long, found binary")


def grouped(key: np.ndarray, check: np.ndarray | None, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by key, check and document; start of each key's group in that order)."""
    order = np.lexsort((doc, key)) if check is None else np.lexsort((doc, check, key))
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    if check is not None:
        check = check[order]
        new[1:] |= check[1:] != check[:-1]
    return order, np.flatnonzero(new)


def shared(fp: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group starts, whether each group has two documents)."""
    order, start = grouped(fp, None, doc)
    doc = doc[order]
    last = np.concatenate([start[1:], [len(fp)]])[: len(start)].astype(int) - 1
    return order, start, doc[start] != doc[last]


def buckets_of(spark: SparkSession) -> int:
    """Bits of the bucket number: a few buckets for each shuffle partition."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())


def merged(runs: DataFrame, bits: int, settle, folder: str | None = None) -> DataFrame:
    """Brings each bucket's entries of all runs together; ``settle`` gives the rows of one bucket (runs go to ``folder``)."""

    def run(batches):
        bucket, held, files = None, [], {}

        def settle_held():
            columns = [np.concatenate(c) for c in zip(*held)]
            rows = settle(bucket, bits, *columns)
            held.clear()
            return batch_of(stashed(rows, folder) if folder else rows)

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket and held:
                    yield settle_held()
                bucket = row["bucket"]
                held.append(loaded(row, files))
                if len(files) > 200:
                    files.popitem()[1].close()
        if held:
            yield settle_held()

    return runs.repartition(1 << bits, "bucket").sortWithinPartitions("bucket").mapInArrow(run, RUN)


def cut_by_bucket(key: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of ascending keys; the bucket is their leading bits."""
    cut = np.searchsorted(key >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
    return ((i, a, b) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a)


def settled(key: np.ndarray, doc: np.ndarray, bits: int) -> list[tuple]:
    """What a flush makes: kind 1, pairs of a document and a key that another one of the task has too; kind 0, entries of
    a run (keys, a document for each); kind 3, pairs of a document and the first one of the task with one of its keys."""
    order, start, many = shared(key, doc)
    key, doc = key[order], doc[order]
    size = np.diff([*start, len(key)])
    use = np.repeat(many, size)
    rows = by_doc(1, doc[use], key[use], bits) + stars(doc, start, use, bits)
    key, doc = key[start], doc[start]
    return rows + [(0, i, None, key[a:b], doc[a:b], None, None) for i, a, b in cut_by_bucket(key, bits)]


def stars(doc: np.ndarray, start: np.ndarray, use: np.ndarray, bits: int) -> list[tuple]:
    """Kind 3 rows: each document with the first documents of its groups, once each."""
    first = np.repeat(doc[start], np.diff([*start, len(doc)])) if len(start) else doc
    use = use & (doc != first)
    if not use.any():
        return []
    pairs = np.unique(np.stack([doc[use], first[use]], 1), axis=0)
    return by_doc(3, pairs[:, 0].copy(), pairs[:, 1].copy(), bits)


def settle_keys(bucket: int, bits: int, key: np.ndarray, doc: np.ndarray) -> list[tuple]:
    """For ``merged``: kind 1 and kind 3 rows, as of ``settled``, over all runs."""
    order, start, many = shared(key, doc)
    key, doc = key[order], doc[order]
    use = np.repeat(many, np.diff([*start, len(key)]))
    return by_doc(1, doc[use], key[use], bits) + stars(doc, start, use, bits)


def settle_run(bucket: int, bits: int, key: np.ndarray, doc: np.ndarray) -> list[tuple]:
    """Compaction: one entry for each key, with its first document."""
    order, start = grouped(key, None, doc)
    return [(0, bucket, None, key[order][start], doc[order][start], None, None)]


def of_documents(docs: DataFrame, pairs: DataFrame, width: int, kind: type, most_broadcast: int) -> DataFrame:
    """The documents that packed pairs name, with ``found``: their values.

    Documents are first narrowed by their keys, broadcast if there are at most ``most_broadcast``; beyond that all of them
    go through the join.
    """
    lists = written(gathered(pairs, width, kind), "runs-lists")
    if lists.count() <= most_broadcast:
        docs = docs.join(F.broadcast(lists.select("doc")), "doc", "left_semi")
    return docs.join(lists, "doc")
