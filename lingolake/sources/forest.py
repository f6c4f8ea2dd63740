"""A synthetic forest over documents: what a parser would give, by integer arithmetic only.

No parser is at hand, so that detectors can be run and checked over whole tables, each document's tokens are cut into
sentences of ``SIZE`` and get heads, tags, relations, features and some trigger words by their position and document
number.  It says nothing about language; every rule's branches occur in it.  ``FOREST_SQL`` builds the same tokens in
standard SQL.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..operators.trees import sentences_of

SIZE = 12
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]"
FORMS = """why what it be by von durch warum was None one elder every the n't 's 'd Ai ca gonna nen n ne Vereins- -konsum ?
    KG who wie der many viele talkin' gon na kinda und""".split()
UPOS = "NOUN VERB AUX ADJ PRON ADP DET NUM ADV PUNCT PROPN PART VERB".split()
XPOS = "NN VBN JJ JJR ART PPOSS PIS ADJA ADJA VVPP AUX CD JJ IN DT JJS _".split()
RELATIONS = "nsubj conj obj ccomp aux:pass obl acl:relcl cop case det conj nsubj:pass advmod xcomp appos nmod expl root acl obl:agent iobj aux conj".split()
LEMMAS = "know idea be it what do können by have would frage not es we i they wissen reason will".split()
LEMMA_AT, UPOS_AT, XPOS_AT, RELATION_AT, FEATS_AT = "o * 11 + d * 5 + s * 3", "o * o + 3 * o * d + 5 * s + d", "o * d + 5 * o * s + 2 * d + o", "o * o * s + 7 * o + 11 * d + 3 * s", "o * 2 + d + s * 3"
FEATS = ["", "Number=Plur", "NumType=Ord", "Degree=Cmp", "Degree=Sup", "VerbForm=Part", "Gender=Masc|Case=Acc", "Gender=Fem|Case=Dat", "NumType=Card", "Gender=Neut|Case=Nom|Number=Sing", "Number=Sing"]


#: Hand-made sentences among them, for rules that need many nodes to agree: form, lemma, upos, xpos, relation, head, features.
PATTERNS = [
    """It it PRON PRP nsubj 3 _, was be AUX VBD cop 3 _, John John PROPN NNP root 0 _, who who PRON WP nsubj 5 _, broke break VERB VBD acl:relcl 3 _,
    the the DET DT det 7 _, vase vase NOUN NN obj 5 _, in in ADP IN case 10 _, the the DET DT det 10 _, elder elder ADJ JJR obj 5 _, ! ! PUNCT . punct 3 _, so so ADV RB advmod 3 _""",
    """What what PRON WP nsubj 6 _, he he PRON PRP nsubj 3 _, wanted want VERB VBD acl:relcl 1 _, was be AUX VBD cop 6 _, to to PART TO mark 6 _,
    leave leave VERB VB root 0 _, every every DET DT det 8 _, one one NOUN NN obj 6 _, by by ADP IN case 10 _, John John PROPN NNP obl 6 _, . . PUNCT . punct 6 _, None none NOUN NN obj 6 _""",
    """Warum warum ADV WRB root 0 _, the the DET DT det 4 _, small small ADJ JJ amod 4 _, man man NOUN NN nmod 1 _, of of ADP IN case 7 _, the the DET DT det 7 _,
    hall hall NOUN NN nmod 4 _, and and CCONJ CC cc 10 _, by by ADP IN case 10 _, what what PRON WP conj 7 _, ? ? PUNCT . punct 1 _, ! ! PUNCT . punct 1 _""",
    """Fred Fred PROPN NNP nsubj 2 _, prepares prepare VERB VBZ root 0 _, and and CCONJ CC cc 5 _, Susan Susan PROPN NNP nsubj 5 _, eats eat VERB VBZ conj 2 _,
    the the DET DT det 7 _, food food NOUN NN obj 5 _, of of ADP IN case 9 _, Rome Rome PROPN NNP nmod 7 _, and and CCONJ CC cc 11 _, Milan Milan PROPN NNP conj 9 _, . . PUNCT . punct 2 _""",
    """Die die DET ART nsubj:pass 6 _, von von ADP APPR case 4 _, dem der DET ART det 4 _, Koch Koch NOUN NN obl:agent 6 _, wird werden AUX VAFIN aux:pass 6 _,
    gelobt loben VERB VVPP root 0 _, oder oder CCONJ KON cc 8 _, bedrängt bedrängen ADJ VVPP conj 6 _, durch durch ADP APPR case 10 _, Lärm Lärm NOUN NN obl 8 _,
    n n DET ART det 12 _, Kleinwagen Kleinwagen NOUN NN obj 8 Gender=Masc|Case=Acc""",
]
ROWS = [node.split() for pattern in PATTERNS for node in re.split(r",\s+", pattern)]
#: A full sentence s of document d follows pattern (d + 3 * s) % EVERY, if there is one of that number.
EVERY = 9


def forest(docs: DataFrame, *fields: str, text: bool = True, mwts: bool = True) -> DataFrame:
    """Sentences (see ``operators.trees``) of documents (doc_id, text, lang); null ids and texts give none.

    Tokens are cut by Spark, and trees grown on whole Arrow batches of them, as a parser's front end would give them.  It keeps
    the partitions of ``docs``: of a table in one file, deal the documents to more (see ``plans.catalog``).  ``fields`` are those that
    nodes are to have besides ``ord`` (all, if none are named); what nobody reads needn't come out of the workers.
    """
    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.expr(f"regexp_extract_all(text, '{TOKEN.replace(chr(92), chr(92) * 2)}', 0)").alias("w")).filter("size(w) > 0")

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                yield grown(batch.slice(i, 64), fields, text=text, mwts=mwts)

    return rows.mapInArrow(run, sentences_of(*fields, text=text, mwts=mwts))


def _taken(pool: list[str], at: np.ndarray) -> pa.Array:
    return pa.array(pool, pa.string()).take(pa.array(at))


def grown(batch: pa.RecordBatch, fields: tuple[str, ...] = (), *, text: bool = True, mwts: bool = True) -> pa.RecordBatch:
    """The sentences of a batch (doc_id, lang, tokens), all tokens at once; ``fields`` as for ``forest``."""
    keys = batch.column(0).to_numpy(zero_copy_only=False)
    tokens, counts = batch.column(2).flatten(), pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
    total, begin = int(counts.sum()), np.cumsum(counts) - counts
    d, i = np.repeat(keys, counts), np.arange(total) - np.repeat(begin, counts)
    s, o = i // SIZE, i % SIZE + 1
    # one number a sentence; where each begins among the tokens
    first = np.flatnonzero(o == 1)
    size = np.diff(np.append(first, total))
    mine = np.repeat(np.arange(len(first)), size)
    k = np.where(size[mine] == SIZE, np.fmod(d + 3 * s, EVERY), EVERY)
    fixed, at = k < len(PATTERNS), np.minimum(k, len(PATTERNS) - 1) * SIZE + o - 1
    numbers = {"o": o, "d": d, "s": s}

    def told(column: int, pool: list[str], number: str) -> np.ndarray:
        """Places in the pool and, behind it, in a column of the patterns."""
        return np.where(fixed, len(pool) + at, np.fmod(eval(number, {}, numbers), len(pool)))  # noqa: S307 (the fixed formulas above)

    columns = [[r[c].replace("_", "") if c == 6 else r[c] for r in ROWS] for c in range(7)]
    own = np.where(np.fmod(o * 5 + d + s, 3) == 0, total + np.fmod(o * 7 + d * 3 + s * 11, len(FORMS)), np.arange(total))
    forms = pa.concat_arrays([tokens.cast(pa.string()), pa.array(FORMS + columns[0], pa.string())]).take(pa.array(np.where(fixed, total + len(FORMS) + at, own)))
    glue = (o > 1) & (np.fmod(o + d + s, 3) == 0)
    gap = (o > 1) & ~glue
    length = pc.utf8_length(forms).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(length + gap)
    ends = ends - np.repeat((np.cumsum(length + gap) - length - gap)[first], size)

    def lemmas() -> pa.Array:
        lemma = np.where(np.fmod(o + 2 * d + s, 2) == 0, np.arange(total), total + np.fmod(eval(LEMMA_AT, {}, numbers), len(LEMMAS)))  # noqa: S307
        return pa.concat_arrays([pc.utf8_lower(forms), pa.array(LEMMAS + columns[1], pa.string())]).take(pa.array(np.where(fixed, total + len(LEMMAS) + at, lemma)))

    def heads() -> pa.Array:
        head = np.where(o == 1, 0, 1 + np.fmod(7 * o + 3 * d + s, np.maximum(o - 1, 1)))
        return pa.array(np.where(fixed, np.array([int(x) for x in columns[5]])[at], head).astype(np.int32))

    def feats() -> pa.Array:
        parts = [[x.split("=") for x in f.split("|") if x] for f in FEATS + columns[6]]
        many, flat = np.array([len(x) for x in parts]), [x for part in parts for x in part]
        code = told(6, FEATS, FEATS_AT)
        n = many[code]
        entry = np.repeat((np.cumsum(many) - many)[code] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return pa.MapArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), _taken([x[0] for x in flat], entry), _taken([x[1] for x in flat], entry))

    made = {
        "ord": lambda: pa.array(o, pa.int32()), "form": lambda: forms, "lemma": lemmas, "upos": lambda: _taken(UPOS + columns[2], told(2, UPOS, UPOS_AT)), "xpos": lambda: _taken(XPOS + columns[3], told(3, XPOS, XPOS_AT)), "feats": feats,
        "head": heads, "deprel": lambda: _taken(RELATIONS + columns[4], told(4, RELATIONS, RELATION_AT)), "t_start": lambda: pa.array(ends - length, pa.int32()), "t_end": lambda: pa.array(ends, pa.int32()),
    }
    node = {name: make() for name, make in made.items() if not fields or name in ("ord", *fields)}
    cut = pa.array(np.append(first, total), pa.int32())
    out = {"doc_id": pa.array(d[first], pa.int64()), "view": pa.array(["_InitialView"]).take(pa.array(np.zeros(len(first), np.int32))), "sent_id": pa.array(s[first], pa.int32()), "lang": batch.column(1).take(pa.array(np.repeat(np.arange(len(keys)), counts)[first]))}
    if text:
        spaced = pc.binary_join_element_wise(_taken(["", " "], gap.astype(np.int64)), forms, "")
        out["text"] = pc.binary_join(pa.ListArray.from_arrays(cut, spaced), "")
    out["nodes"] = pa.ListArray.from_arrays(cut, pa.StructArray.from_arrays(list(node.values()), list(node)))
    if mwts:
        joint = np.flatnonzero((o < size[mine]) & (np.fmod(o + d + s, 2) == 0))
        mwt = {"form": pc.utf8_lower(pc.binary_join_element_wise(forms.take(pa.array(joint)), forms.take(pa.array(joint + 1)), "")), "first_ord": pa.array(o[joint], pa.int32()), "last_ord": pa.array(o[joint] + 1, pa.int32())}
        out["mwts"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(mine[joint], minlength=len(first)))), pa.int32()), pa.StructArray.from_arrays(list(mwt.values()), list(mwt)))
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _listed(values: list[str], number: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{quoted}][CAST(({number}) % {len(values)} + 1 AS INTEGER)]"


def _field(column: int, otherwise: str) -> str:
    quoted = ", ".join("'" + (r[column].replace("_", "") if column == 6 else r[column]).replace("'", "''") + "'" for r in ROWS)
    return f"CASE WHEN k < {len(PATTERNS)} THEN [{quoted}][CAST(k * {SIZE} + o AS INTEGER)] ELSE {otherwise} END"


#: ``tok``: a row for each node (d, lang, s, o, form, glue, lemma, upos, xpos, feats, head, deprel, b, e); ``anc``: (d, s, o, a), each node with itself and its ancestors.
FOREST_SQL = f"""
words AS (SELECT doc_id AS d, lang, regexp_extract_all(text, '{TOKEN}') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
cut AS (SELECT d, lang, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM words),
placed AS (SELECT d, lang, CAST(i // {SIZE} AS BIGINT) AS s, CAST(i % {SIZE} + 1 AS BIGINT) AS o, x FROM cut),
kinds AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY d, s) = {SIZE} THEN (d + 3 * s) % {EVERY} ELSE {EVERY} END AS k FROM placed),
formed AS (SELECT d, lang, s, o, k, {_field(0, f"CASE WHEN (o * 5 + d + s) % 3 = 0 THEN {_listed(FORMS, 'o * 7 + d * 3 + s * 11')} ELSE x END")} AS form, (o > 1 AND (o + d + s) % 3 = 0) AS glue FROM kinds),
tok AS MATERIALIZED (SELECT d, lang, s, o, form, glue,
    {_field(1, f"CASE WHEN (o + 2 * d + s) % 2 = 0 THEN lower(form) ELSE {_listed(LEMMAS, LEMMA_AT)} END")} AS lemma,
    {_field(2, _listed(UPOS, UPOS_AT))} AS upos, {_field(3, _listed(XPOS, XPOS_AT))} AS xpos, {_field(6, _listed(FEATS, FEATS_AT))} AS feats,
    CAST({_field(5, "CAST(CASE WHEN o = 1 THEN 0 ELSE 1 + ((7 * o + 3 * d + s) % greatest(o - 1, 1)) END AS VARCHAR)")} AS BIGINT) AS head, {_field(4, _listed(RELATIONS, RELATION_AT))} AS deprel,
    CAST(sum(length(form) + CASE WHEN o > 1 AND NOT glue THEN 1 ELSE 0 END) OVER (PARTITION BY d, s ORDER BY o) - length(form) AS BIGINT) AS b,
    CAST(sum(length(form) + CASE WHEN o > 1 AND NOT glue THEN 1 ELSE 0 END) OVER (PARTITION BY d, s ORDER BY o) AS BIGINT) AS e
    FROM formed),
anc AS (SELECT d, s, o, o AS a, head AS up FROM tok UNION ALL SELECT c.d, c.s, c.o, c.up, t.head FROM anc c JOIN tok t ON t.d = c.d AND t.s = c.s AND t.o = c.up WHERE c.up > 0)
"""
