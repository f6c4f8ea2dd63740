"""Parsers as sources of sentences: thin adapters around models that the caller brings.

A *loader* takes a language and gives a pipeline; it runs in the Python workers, once a worker and language.  An
*adapter* takes what the pipeline makes of a text and gives its sentences: lists of tokens (form, lemma, upos, xpos, feats,
head, deprel, begin, end), and the words of multiword tokens (form, first, last).  Texts go to the workers in Arrow batches.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions import lexicon as L
from .trees import SENTENCES

#: What keeps model libraries from asking a network.
OFFLINE = {"HF_HUB_OFFLINE": "1", "TRANSFORMERS_OFFLINE": "1", "HF_DATASETS_OFFLINE": "1"}
ENTITIES = "doc_id long, view string, begin int, end int, label string"
#: Pipelines of this worker, by loader and language.
LOADED: dict[tuple, object] = {}


def loaded(loader: Callable, lang: str | None):
    """The pipeline for a language: loaded when it is first asked for, then kept."""
    key = (getattr(loader, "__module__", ""), getattr(loader, "__qualname__", repr(loader)), lang)
    if key not in LOADED:
        LOADED[key] = loader(lang)
    return LOADED[key]


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _over(docs: DataFrame, loader: Callable, rows_of: Callable, schema: str, offline: bool) -> DataFrame:
    wanted = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if offline:
            os.environ.update(OFFLINE)
        for batch in batches:
            rows = []
            for doc, view, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text and text.strip():
                    rows += rows_of(doc, view, lang, text, loaded(loader, lang)(text))
            yield pa.RecordBatch.from_pylist(rows, schema=wanted)

    return docs.select("doc_id", "view", "lang", "text").mapInArrow(run, schema)


def parsed(docs: DataFrame, loader: Callable, adapter: Callable, *, offline: bool = True) -> DataFrame:
    """Sentences (see ``trees``) of documents (doc_id, view, lang, text); blank texts have none."""

    def rows_of(doc, view, lang, text, result):
        out = []
        for i, (tokens, words) in enumerate(adapter(result)):
            if tokens:
                names = ("form", "lemma", "upos", "xpos", "feats", "head", "deprel", "t_start", "t_end")
                nodes = [{"ord": o, **dict(zip(names, t)), "feats": list((t[4] or {}).items())} for o, t in enumerate(tokens, 1)]
                out.append({"doc_id": doc, "view": view, "sent_id": i, "lang": lang, "text": text[tokens[0][7] : tokens[-1][8]], "nodes": nodes, "mwts": [dict(zip(("form", "first_ord", "last_ord"), w)) for w in words]})
        return out

    return _over(docs, loader, rows_of, SENTENCES, offline)


def entities(docs: DataFrame, loader: Callable, spans: Callable, *, offline: bool = True) -> DataFrame:
    """(doc_id, view, begin, end, label): a row an entity, with the model's own label; ``spans`` gives (begin, end, label) of a result."""

    def rows_of(doc, view, lang, text, result):
        return [{"doc_id": doc, "view": view, "begin": b, "end": e, "label": label} for b, e, label in spans(result)]

    return _over(docs, loader, rows_of, ENTITIES, offline)


def missing(docs: DataFrame, sentences: DataFrame | None, found: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(views to parse, views to look for entities in): each layer is filled in by itself, where it has nothing for a view."""
    keys = ["doc_id", "view"]
    left = lambda layer: docs if layer is None else docs.join(layer.select(*keys).distinct(), keys, "left_anti")
    return left(sentences), left(found)


def tagged(doc) -> Iterator[tuple[list, list]]:
    """Adapter for pipelines whose tokens have ``idx``, ``tag_``, ``lemma_``, ``dep_`` and ``head``: the tag only, no coarse one; a root is its own head."""
    for sentence in doc.sents:
        tokens = [t for t in sentence if t.text.strip()]
        place = {t.i: o for o, t in enumerate(tokens, 1)}
        yield [(t.text, t.lemma_, "", t.tag_, {}, 0 if t.head.i == t.i else place.get(t.head.i, 0), "root" if t.head.i == t.i else t.dep_, t.idx, t.idx + len(t.text)) for t in tokens], []


def universal(doc) -> Iterator[tuple[list, list]]:
    """Adapter for pipelines whose sentences have ``tokens`` of ``words`` with upos, xpos, feats, head and deprel; words of a multiword token share its span."""
    for sentence in doc.sentences:
        tokens, words = [], []
        for t in sentence.tokens:
            first = len(tokens) + 1
            for w in t.words:
                feats = dict(f.split("=", 1) for f in (w.feats or "").split("|") if "=" in f)
                tokens.append((w.text, w.lemma or "", w.upos or "", w.xpos or "", feats, w.head, "root" if w.head == 0 else w.deprel, t.start_char, t.end_char))
            if len(t.words) > 1:
                words.append((t.text, first, len(tokens)))
        yield tokens, words


def universal_entities(doc) -> Iterator[tuple[int, int, str]]:
    for e in doc.ents:
        yield e.start_char, e.end_char, e.type


def starred(split: Callable, tag: Callable, lemma: Callable) -> Callable:
    """A pipeline of functions for English: ``split(text)`` to sentences of (begin, end) spans, ``tag(words)`` to Penn tags, ``lemma(word,
    kind)`` to lemmas of lower-cased words.  Its relations are a dummy: the first token is the root and all others hang on it."""

    def run(text: str) -> list[tuple[list, list]]:
        out = []
        for spans in split(text):
            words = [text[b:e] for b, e in spans]
            rows = []
            for i, (word, xpos, (b, e)) in enumerate(zip(words, tag(words), spans)):
                kind = "v" if xpos.startswith("V") else "a" if xpos.startswith("J") else "r" if xpos.startswith("RB") else "n"
                rows.append((word, lemma(word.lower(), kind), "", L.PENN_TO_UPOS.get(xpos, "X"), {}, 0 if i == 0 else 1, "ROOT" if i == 0 else "dep", b, e))
            out.append((rows, []))
        return out

    return run
