"""SentencePiece encoding and decoding with the tokenizers library as the backend.

The model file's protobuf is parsed here; normaliser, white-space marker, scores (unigram) or merges (BPE) and byte
fallback are rebuilt as parts of the tokenizers library.  That library encodes every whole text, in batches, and the
sentencepiece library encodes every whole text too: ``parity`` says whether both give the same ids.  Only a text of more
than ``part`` characters goes through both libraries in parts, for memory, where that provably gives the same ids (see
``Backend.parts``).  Decoding takes a text's own ids, put together: their pieces' bytes one after the other, or the
tokenizers library where ids stand for more than bytes.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import pieces

MARK = "▁"
#: A space that a text may be parted at: something other than white space comes before it, and something after it.
CUT = re.compile(f"(?<=[^ {MARK}]) (?=.)", re.S)
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: varints as numbers, all else as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


@dataclass
class Model:
    """What a model file says: (piece, score, type) by id, and the settings that matter for encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True
    suffix: bool = False

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                out.pieces.append((piece, score, kind))
            elif number == 2:
                for n, v in fields(value):
                    if n == 3:
                        out.kind = v
                    elif n == 24:
                        out.suffix = bool(v)
                    elif n == 35:
                        out.byte_fallback = bool(v)
                    elif n == 40:
                        out.unk = v
            elif number == 3:
                for n, v in fields(value):
                    if n == 2:
                        out.charsmap = v
                    elif n == 3:
                        out.dummy_prefix = bool(v)
                    elif n == 4:
                        out.remove_extra = bool(v)
                    elif n == 5:
                        out.escape = bool(v)
        return out


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs by the order in which sentencepiece would merge them: the score of what they make."""
    rank = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    out = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in rank and right in rank:
                    out.append((-score, rank[piece], rank[left], rank[right], left, right))
    out.sort()
    return [(x[4], x[5]) for x in out]


class Backend:
    """Encodes and decodes as sentencepiece does; ``checked`` also compares with that library."""

    def __init__(self, path: str, checked: bool = True, batch: int = 64, part: int = 1 << 18):
        from tokenizers import Tokenizer, decoders, models

        with open(path, "rb") as f:
            raw = f.read()
        self.model = m = Model.parse(raw)
        if m.kind == BPE:
            core = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m), unk_token=m.pieces[m.unk][0], fuse_unk=True, byte_fallback=m.byte_fallback)
        elif m.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk, m.byte_fallback)
        else:
            raise ValueError(f"model type {m.kind} isn't unigram or BPE")
        self.tokenizer = Tokenizer(core)
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.charsmap = self._charsmap()
        self.control = {p for p, _, kind in m.pieces if kind in (CONTROL, UNKNOWN)}
        usable = [p for p, _, kind in m.pieces if kind in (NORMAL, USER)]
        #: parting a text before a marker is only right if no piece and no rule of the normaliser spans that place, and if the marker
        #: is known (unknown characters in a row are one id)
        self.cuts = MARK in usable and not any(re.search(f"[^{MARK}]{MARK}", p) for p in usable) and m.escape and m.dummy_prefix and not m.suffix and not m.charsmap
        self.reference = None
        if checked:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=raw)
        #: the bytes of all pieces, in a row, and where each begins; ids without bytes of their own
        raw_pieces = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind in (NORMAL, USER) else b"" for p, _, kind in m.pieces]
        self.flat, self.length = np.frombuffer(b"".join(raw_pieces), np.uint8), np.array([len(p) for p in raw_pieces])
        self.begin = np.cumsum(self.length) - self.length
        self.special = np.array([kind not in (NORMAL, USER, BYTE) for _, _, kind in m.pieces])
        self.batch, self.part = batch, part

    def _charsmap(self):
        if not self.model.charsmap:
            return None
        from tokenizers import normalizers

        return normalizers.Precompiled(self.model.charsmap)

    def normalized(self, text: str) -> str:
        """What the model's pieces are matched against."""
        m = self.model
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if m.remove_extra:
            text = re.sub(" {2,}", " ", text).strip(" ")
        if not text:
            return ""
        if m.dummy_prefix:
            text = text + " " if m.suffix else " " + text
        return text.replace(" ", MARK) if m.escape else text

    def parts(self, text: str) -> list[str]:
        """Texts whose ids, one after the other, are those of the text: itself, or parts of a very long one.  A part after the
        first had a space before it, which the dummy prefix stands for."""
        out, begin = [], 0
        while self.cuts and len(text) - begin > self.part and (m := CUT.search(text, begin + self.part)):
            out.append(text[begin : m.start()])
            begin = m.end()
        return [*out, text[begin:]]

    @classmethod
    def of_worker(cls, path: str, checked: bool = True) -> Backend:
        """This process's backend for a file: it is built once."""
        if (path, checked) not in BACKENDS:
            BACKENDS[path, checked] = cls(path, checked)
        return BACKENDS[path, checked]

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, str, str, bool]]:
        """(ids, decoded text, normalised text with spaces, parity) of each text."""
        parts = [self.parts(t) if t else [] for t in texts]
        flat = [p for own in parts for p in own]
        plain = list(map(self.normalized, flat))
        ids, same = [], []
        while len(ids) < len(flat):
            # as many at a time as have about ``part`` characters, for memory
            begin = end = len(ids)
            size = 0
            while end < min(len(flat), begin + self.batch) and (end == begin or size + len(plain[end]) <= self.part):
                size += len(plain[end])
                end += 1
            for e, text in zip(self.tokenizer.encode_batch_fast(plain[begin:end], add_special_tokens=False), flat[begin:end]):
                ids.append(np.array(e.ids, np.uint32))
                same.append(self.reference is None or np.array_equal(ids[-1], self.reference.encode(text, num_threads=1)))
        cut = self.model.dummy_prefix and not self.model.suffix
        out, at = [], 0
        for own in parts:
            end = at + len(own)
            text = "".join(plain[at:end]).replace(MARK, " ")
            found = np.concatenate([np.zeros(0, np.uint32), *ids[at:end]])
            out.append((found, self.decode(found), text[1:] if cut else text, all(same[at:end])))
            at = end
        return out

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids, without the dummy prefix."""
        ids = np.asarray(ids, np.int64)
        text = None
        if not self.special[ids].any():
            n = self.length[ids]
            ends = np.cumsum(n)
            try:
                text = self.flat[np.repeat(self.begin[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes().decode()
            except UnicodeDecodeError:  # single bytes that make no character
                pass
        if text is None:
            text = self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


#: By file, in each Python worker.
BACKENDS: dict[tuple[str, bool], Backend] = {}


def encode(docs: DataFrame, path: str, *, text: str = "text", keep: list[str] | None = None, checked: bool = True, with_ids: bool = True) -> DataFrame:
    """The ``keep`` columns (all by default) with ``n_pieces``, ``ids`` (if asked for), ``ids_sha256`` (of u32 LE),
    ``decoded_sha256``, ``round_trip`` (decoding gives the normalised text again) and ``parity``.

    A null text is encoded as an empty one, to no ids.  A kept column named like a new one gives way.  No shuffle;
    rows are independent.  ``path`` is the model file's path on the executors.
    """
    new = ["n_pieces", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256", "round_trip", "parity"]
    kinds = {"n_pieces": "long", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string", "round_trip": "boolean", "parity": "boolean"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), *(f"{c} {kinds[c]}" for c in new)])
    arrow = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string(), "boolean": pa.bool_()}

    def run(batches):
        backend = Backend.of_worker(path, checked)
        for batch in pieces(batches, "__text"):
            rows = {c: [] for c in new}
            for ids, decoded, plain, same in backend(batch.column(batch.num_columns - 1).to_pylist()):
                rows["n_pieces"].append(len(ids))
                if with_ids:
                    rows["ids"].append(ids.astype(np.int32))
                rows["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                rows["round_trip"].append(decoded == plain)
                rows["parity"].append(same)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(rows[c], arrow[kinds[c]]) for c in new)], names=[*keep, *new])

    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of the ids in column ``ids`` (null: null)."""
    others = [c for c in rows.columns if c != out]
    source = rows.select(*[rows[f"`{c}`"] for c in others], rows[f"`{ids}`"].alias("__ids"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), f"`{out}` string"])

    def run(batches):
        backend = Backend.of_worker(path, False)
        for batch in batches:
            texts = [None if x is None else backend.decode(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*others, out])

    return source.mapInArrow(run, schema)
