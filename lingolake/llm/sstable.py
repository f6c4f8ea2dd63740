"""Sorted-string tables of token ids.

A shard is one file: blocks of prefix-compressed keys with their values, then a sparse block index, a Bloom filter and
a footer.  A reader finds a key by the filter, a binary search in the index and one range read.

    block   zstd (u32 plain size first) of: per entry  varint shared, varint rest, varint n_ids, rest of the key; then all ids (u32 LE)
    index   per block: u32 length of the first key, the key, u64 offset, u32 size, u32 entries
    bloom   u32 hashes, u64 bits, the bits
    footer  u64 index offset, u64 bloom offset, u64 entries, u64 ids, 8 bytes magic
"""

from __future__ import annotations

import bisect
import gc
import os
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .store import NewFile, new_dir, opened, written
from .stretches import Numbers, Stretches, parted, renewed
from .text import buffers, mix, pieces

MAGIC = b"LLSST\x00\x01\n"
FOOTER = struct.Struct("<QQQQ8s")
BLOCK = 256 << 10
#: A shard is closed once it has so many bytes of blocks, which bounds what its index and filter take.
SHARD = 256 << 20
#: Bytes of text that are encoded at a time (a longer text is a batch of its own); pieces that get their numbers at a time.
BATCH, PIECES = 4 << 20, 1 << 20


def int_key(i: int) -> bytes:
    """Eight bytes that sort as the signed number does."""
    return (i + (1 << 63)).to_bytes(8, "big")


def key_int(key: bytes) -> int:
    return int.from_bytes(key, "big") - (1 << 63)


def _varint(out: bytearray, n: int) -> None:
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            return n, at


def _key_hash(key: bytes) -> int:
    return zlib.crc32(key) | zlib.adler32(key) << 32


def _probes(hashes: np.ndarray, bits: int, number: int) -> np.ndarray:
    h = mix(hashes)
    step = mix(h) | np.uint64(1)
    return np.stack([(h + step * np.uint64(j)) % np.uint64(bits) for j in range(number)])


def _bloom(hashes: np.ndarray, bits: int, number: int) -> np.ndarray:
    """The filter's bytes, a bit a place (the highest bit of a byte first)."""
    out = np.zeros((bits + 7) // 8, np.uint8)
    for i in range(0, len(hashes), 65536):
        at = _probes(hashes[i : i + 65536], bits, number).ravel()
        np.bitwise_or.at(out, at >> np.uint64(3), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
    return out


class Writer:
    """Writes one shard; keys must come in ascending order (equal keys are kept, in the order they come)."""

    def __init__(self, folder: str, name: str = "shard.sst", block: int = BLOCK, bits_per_key: int = 10):
        self.file, self.block, self.bits_per_key = NewFile(folder, name), block, bits_per_key
        self.heads, self.values, self.index, self.hashes = bytearray(), [], [], array("Q")
        self.first = self.last = b""
        self.size = self.n = self.ids = self.in_block = 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.n and key < self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.in_block:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first = key
        for x in (shared, len(key) - shared, len(ids)):
            _varint(self.heads, x)
        self.heads += key[shared:]
        value = ids.astype("<u4").tobytes()
        self.values.append(value)
        self.hashes.append(_key_hash(key))
        self.last, self.size = key, self.size + len(value)
        self.n += 1
        self.in_block += 1
        self.ids += len(ids)
        if self.size >= self.block:
            self._flush()

    def _flush(self) -> None:
        if self.in_block:
            plain = struct.pack("<I", len(self.heads)) + bytes(self.heads) + b"".join(self.values)
            raw = struct.pack("<I", len(plain)) + pa.compress(plain, "zstd", asbytes=True)
            self.index.append(struct.pack("<I", len(self.first)) + self.first + struct.pack("<QII", self.file.size, len(raw), self.in_block))
            self.file.write(raw)
            self.heads, self.values, self.size, self.in_block = bytearray(), [], 0, 0

    def close(self) -> str:
        self._flush()
        at = self.file.size
        self.file.write(b"".join(self.index))
        bits, k = max(64, self.n * self.bits_per_key), 7
        bloom_at = self.file.size
        self.file.write(struct.pack("<IQ", k, bits) + _bloom(np.frombuffer(self.hashes, np.uint64), bits, k).tobytes())
        self.file.write(FOOTER.pack(at, bloom_at, self.n, self.ids, MAGIC))
        return self.file.close()


class Reader:
    def __init__(self, uri: str):
        self.file = opened(uri)
        size = self.file.size()
        index_at, self.bloom_at, self.n, self.ids, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a shard: {uri}")
        raw, at = self._read(index_at, self.bloom_at - index_at), 0
        self.firsts, self.blocks, self.size = [], [], size
        while at < len(raw):
            (n,) = struct.unpack_from("<I", raw, at)
            self.firsts.append(raw[at + 4 : at + 4 + n])
            self.blocks.append(struct.unpack_from("<QII", raw, at + 4 + n))
            at += 20 + n
        self.bloom = None

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def may_have(self, key: bytes) -> bool:
        if self.bloom is None:
            raw = self._read(self.bloom_at, self.size - FOOTER.size - self.bloom_at)
            k, bits = struct.unpack_from("<IQ", raw)
            self.bloom = k, bits, np.frombuffer(raw, np.uint8, offset=12)
        k, bits, data = self.bloom
        at = _probes(np.array([_key_hash(key)], np.uint64), bits, k).ravel()
        return bool((data[at >> np.uint64(3)] & (np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))).all())

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        at, size, n = self.blocks[i]
        raw = self._read(at, size)
        raw = pa.decompress(raw[4:], struct.unpack_from("<I", raw)[0], "zstd", asbytes=True)
        (heads,) = struct.unpack_from("<I", raw)
        at, ids_at, key = 4, 4 + heads, b""
        for _ in range(n):
            shared, at = _read_varint(raw, at)
            rest, at = _read_varint(raw, at)
            count, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + rest]
            at += rest
            yield key, np.frombuffer(raw, "<u4", count, ids_at)
            ids_at += 4 * count

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.blocks)):
            yield from self.block(i)

    def get(self, key: bytes) -> list[np.ndarray]:
        """The values of a key (none, or more where keys repeat)."""
        if not self.n or not self.may_have(key):
            return []
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        out = []
        while i < len(self.firsts) and self.firsts[i] <= key:
            out += [v for k, v in self.block(i) if k == key]
            i += 1
        return out


#: Kinds of bytes for ``cuts``: letters, digits, marks, the apostrophe, white space, the space; 0 isn't looked at (solid).
LETTER, DIGIT, MARK, APOSTROPHE, WHITE, BLANK = range(1, 7)
KIND = np.zeros(256, np.uint8)
KIND[:128] = MARK
KIND[[*range(65, 91), *range(97, 123), *range(0xC3, 0xC6)]] = LETTER
KIND[48:58], KIND[39], KIND[9:14], KIND[32] = DIGIT, APOSTROPHE, WHITE, BLANK
#: First bytes of white space of two and three bytes, and all its characters as numbers of three bytes.
WIDE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
WIDE_WHITE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])
#: By the kinds on both sides (eight times the first, and the second): 1 is a cut, 2 lies within white space.
CUT = np.zeros((8, 8), np.uint8)
CUT[:WHITE, WHITE:] = CUT[WHITE, :WHITE] = 1
CUT[LETTER, [DIGIT, MARK, APOSTROPHE]] = CUT[DIGIT, [LETTER, MARK, APOSTROPHE]] = CUT[MARK, [LETTER, DIGIT]] = CUT[APOSTROPHE, DIGIT] = 1
CUT[WHITE:, WHITE:] = 2
CUT = CUT.ravel()


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8."""
    n, kind = len(data), KIND[data]
    every = np.flatnonzero(data > 0xC1)
    for begin in range(0, len(every), PIECES):
        wide = every[begin : begin + PIECES]
        first, second, third = (data[np.minimum(wide + i, n - 1)].astype(np.int64) for i in range(3))
        latin = (first >= 0xC3) & (first <= 0xC5)
        sign = (first == 0xC3) & ((second == 0x97) | (second == 0xB7))
        kind[wide[sign]] = 0
        kind[wide[latin & ~sign] + 1] = LETTER
        some = WIDE[first]
        white = wide[some][np.isin(first[some] << 16 | second[some] << 8 | third[some] * (first[some] != 0xC2), WIDE_WHITE)]
        for i in range(3):
            at = white[data[white] != 0xC2] if i == 2 else white
            kind[at + i] = WHITE
    return kind


def cuts(data: np.ndarray, offsets: np.ndarray, added: Iterable[bytes] = ()) -> np.ndarray:
    """Where texts may be cut so that their pieces give the ids of the whole: ascending places, both ends included.

    The pre-tokenizer's pattern ends a token where solid characters meet white space and, within these, between letters,
    digits and marks (behind an apostrophe not always).  Of white space before a solid character the last one stands
    alone, or goes with that character if it is a space; at a text's end it is one token.  Letters beyond U+017F and other
    signs are left as they are.  Texts with an added token are cut only before single spaces between solid characters.
    """
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    kind = kinds(data)
    code = CUT[kind[:-1] << 3 | kind[1:]]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    within = np.flatnonzero(code == 2) + 1
    if len(within):
        code[within - 1] = 0
        within = within[data[within] & 0xC0 != 0x80]
        after = within + 1 + (data[within] > 127) + (data[within] > 0xDF)
        code[within[~border[after] & (kind[np.minimum(after, n - 1)] < WHITE)] - 1] = 1
    raw = data.tobytes() if added else b""
    for token in added:
        at = raw.find(token)
        while at >= 0:
            held = int(np.searchsorted(offsets, at, "right"))
            a, b = int(offsets[held - 1]), int(offsets[held])
            if at + len(token) > b:  # it would reach into the next text
                at = raw.find(token, at + 1)
                continue
            solid = kind[a:b] < WHITE
            code[a : b - 1] = 0
            code[a : max(a, b - 2)] = solid[:-2] & (kind[a + 1 : b - 1] == BLANK) & solid[2:]
            at = raw.find(token, b)
    border[1:n] |= code == 1
    return np.flatnonzero(border)


class PieceEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library (without a normaliser); each distinct piece once.

    Texts are cut where the ids of the pieces are those of the whole (``cuts``).  Pieces get numbers a batch at a time: Arrow
    tells the distinct ones, so that a Python object is made for these only.  New ones are encoded many at a time as one
    text and parted by the bytes of their tokens.  Of those seen, ``most`` and the ``most`` of the generation before are kept.
    """

    def __init__(self, path: str, most: int = 650_000, batch: int = 1000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.batch = Tokenizer.from_file(path), most, batch
        added = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.size[i] = len(added.get(i, token))
        self.added = list(added.values())
        self.seen = Stretches()
        self.known = Numbers(self.seen)

    @classmethod
    def of_worker(cls, path: str) -> PieceEncoder:
        """This process's encoder for a file: what one task has seen helps the next."""
        if path not in ENCODERS:
            ENCODERS[path] = cls(path)
        return ENCODERS[path]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: np.ndarray, numbers: np.ndarray) -> None:
        """Encodes new pieces."""
        raw, sizes = b"".join(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        kind, starts = kinds(np.frombuffer(raw, np.uint8)), np.cumsum(sizes) - sizes
        white = np.add.reduceat(kind >= WHITE, starts, dtype=np.int64)
        spaced = (kind[starts] == BLANK) & (white == 1) & (sizes > 1)
        # solid ones behind a space follow one another, others are parted by line ends; the rest has white space within
        for group, between in ((spaced, b""), (white == 0, b"\n"), ((white > 0) & ~spaced, None)):
            at = np.flatnonzero(group)
            for i in range(0, len(at), self.batch):
                some, ends = at[i : i + self.batch], None
                part = pieces[some].tolist()
                if between is not None:
                    (ids,) = self._ids([between.join(part).decode()])
                    step = 1 + len(between)
                    lengths = np.ones(step * len(some) - len(between), np.int64)
                    lengths[::step] = sizes[some]
                    ends = parted(self.size, ids, lengths)
                if ends is None:
                    every, step = self._ids([p.decode() for p in part]), 1
                    ids, ends = np.concatenate(every), np.cumsum([len(x) for x in every])
                self.seen.add(numbers[some], ids, np.append(0, ends[:-1])[::step], ends[::step])

    def __call__(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        if len(self.known) > self.most:
            self.seen, (self.known,) = renewed(self.seen, [self.known])
        data, offsets = buffers(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        places = cuts(data, offsets, self.added)
        found, sizes = [], np.zeros(len(places), np.int64)
        # many bytes objects, but no cycles: the collector would only walk through them
        collecting = gc.isenabled()
        gc.disable()
        try:
            for i in range(0, len(places) - 1, PIECES):
                part = places[i : i + PIECES + 1]
                cut = pa.Array.from_buffers(pa.large_binary(), len(part) - 1, [None, pa.py_buffer(part), pa.py_buffer(data)]).dictionary_encode()
                distinct = cut.dictionary.to_numpy(zero_copy_only=False)
                numbers, new = self.known.of(distinct)
                if len(new):
                    self._learn(distinct[new], numbers[new])
                numbers = numbers[cut.indices.to_numpy()]
                found.append(self.seen.gather(numbers))
                sizes[i + 1 : i + len(part)] = self.seen.size[numbers]
        finally:
            if collecting:
                gc.enable()
        ids = np.concatenate([np.zeros(0, np.uint32), *found]) if len(found) != 1 else found[0]
        ends = np.cumsum(sizes)[np.searchsorted(places, offsets)].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


#: By file, in each Python worker.
ENCODERS: dict[str, PieceEncoder] = {}


def write_shards(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 0, shards: int | None = None, folder: str | None = None, most: int = SHARD, block: int = BLOCK) -> DataFrame:
    """Encodes the texts into shards in key order; a row per shard: number (ascending with the keys), uri, entries, ids.

    Keys are numbers; rows with a null key come first, under the least key.  A null text is empty (only the end id).
    The rows are dealt by key range and sorted there; a task writes a shard a block at a time and begins another one at
    ``SHARD`` bytes.  A shard appears under its name when it is whole, so a lost executor costs its tasks only.
    """
    spark = docs.sparkSession
    folder = folder or new_dir(spark, "sst")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("key"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(shards, "key").sortWithinPartitions("key").withColumn("shard", F.spark_partition_id())

    def run(batches):
        encode, writer, part, number = PieceEncoder.of_worker(tokenizer), None, 0, 0
        schema = pa.schema([("shard", pa.int64()), ("uri", pa.string()), ("entries", pa.int64()), ("ids", pa.int64())])

        def told():
            return pa.RecordBatch.from_pydict({"shard": [part << 32 | number], "uri": [writer.close()], "entries": [writer.n], "ids": [writer.ids]}, schema)

        for batch in pieces(batches, most=BATCH):
            part = batch.column(2)[0].as_py()
            for k, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                if writer is None:
                    writer = Writer(folder, f"{part:06d}-{number:06d}.sst", block)
                writer.add(int_key(k), np.append(ids, np.uint32(end_id)))
                if writer.file.size >= most:
                    yield told()
                    writer, number = None, number + 1
        if writer:
            yield told()

    return written(rows.mapInArrow(run, "shard long, uri string, entries long, ids long"), "sst-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """A row per document from the shards' files: key, start (ids of all before it), n_tokens, ids_crc32."""
    # one row a shard, not a document, goes through this window
    before = F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("shard")) - F.col("ids")
    plan = manifest.select("shard", "uri", before.alias("start"))
    plan = plan.repartition(max(1, manifest.count()), "shard")

    def run(batches):
        for batch in batches:
            for uri, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                reader = Reader(uri)
                for i in range(len(reader.blocks)):
                    rows = []
                    for key, ids in reader.block(i):
                        rows.append((key_int(key), start, len(ids), zlib.crc32(ids)))
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["key", "start", "n_tokens", "ids_crc32"])

    return plan.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")
