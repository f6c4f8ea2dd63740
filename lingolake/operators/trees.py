"""Sentences as rows with an array of nodes, and what the detectors ask of a tree.

``nodes`` is an array of structs (ord, form, lemma, upos, xpos, feats, head, deprel, t_start, t_end); ord counts from 1,
head 0 is the technical root.  ``plain`` is what detection filters on; ``with_ancestors`` adds ``anc`` to the sentences that are
left: the node's ord and those of its ancestors, so that subtrees are filters.  All of it is expressions on one row: no
shuffle, and detection keeps the scan's partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType, _parse_datatype_string

NODE = "struct<ord:int,form:string,lemma:string,upos:string,xpos:string,feats:map<string,string>,head:int,deprel:string,t_start:int,t_end:int>"
SENTENCES = f"doc_id long, view string, sent_id int, lang string, text string, nodes array<{NODE}>, mwts array<struct<form:string,first_ord:int,last_ord:int>>"


def sentences_of(*fields: str, text: bool = True, mwts: bool = True) -> StructType:
    """The type of sentences whose nodes have ``ord`` and some fields only (all, if none are named) and no nulls in them."""
    node = StructType([StructField(f.name, f.dataType, False) for f in _parse_datatype_string(NODE) if not fields or f.name in ("ord", *fields)])
    kept = [f for f in _parse_datatype_string(SENTENCES) if (text or f.name != "text") and (mwts or f.name != "mwts")]
    return StructType([StructField(f.name, ArrayType(node, False), False) if f.name == "nodes" else f for f in kept])


def _node_fields(rows: DataFrame) -> list[StructField]:
    return rows.schema["nodes"].dataType.elementType.fields


def fixed(rows: DataFrame) -> DataFrame:
    """The same rows, with columns that the optimizer takes as given.

    Columns that are long expressions and are used many times would else be repeated at each use when projections and
    filters are merged; a generator of one row stops that, without a shuffle.
    """
    return rows.select(F.explode(F.array(F.struct(*[f"`{c}`" for c in rows.columns]))).alias("r")).select("r.*")


FIELDS = ("form", "lemma", "upos", "xpos", "deprel")


def plain(sentences: DataFrame) -> DataFrame:
    """Nulls in string fields of nodes become empty, null heads 0; where their type rules nulls out, nothing is done."""
    if not sentences.schema["nodes"].dataType.containsNull and not any(f.nullable for f in _node_fields(sentences)):
        return sentences
    strings = ", ".join(f"'{c}', coalesce(n.{c}, '')" for c in FIELDS)
    return fixed(sentences.withColumn("nodes", F.expr(f"transform(nodes, n -> named_struct('ord', n.ord, {strings}, 'feats', coalesce(n.feats, map()), 'head', coalesce(n.head, 0), 't_start', n.t_start, 't_end', n.t_end))")))


def with_ancestors(rows: DataFrame) -> DataFrame:
    """Each node of ``plain`` rows gets ``anc``: its ord, its ancestors' ords, and the 0 above them.

    Paths are doubled: after k rounds each holds 2 ** k steps, or all there are; so a sentence of n nodes takes
    log2(n) rounds.  A head out of range ends a path like 0; heads in a circle make a long path and no error.
    """
    inner = "element_at(p, -1) >= 1 AND element_at(p, -1) <= size(nodes)"
    rounds = "sequence(1, cast(ceil(log2(greatest(size(nodes), 2))) AS int))"
    paths = f"""aggregate({rounds}, transform(nodes, n -> array(n.ord, n.head)),
        (paths, r) -> transform(paths, p -> if({inner}, concat(p, slice(paths[element_at(p, -1) - 1], 2, size(nodes))), p)))"""
    rows = fixed(rows.withColumn("__paths", F.expr(paths)))
    every = ", ".join(f"'{f.name}', n.{f.name}" for f in _node_fields(rows))
    return fixed(rows.withColumn("nodes", F.expr(f"transform(nodes, (n, i) -> named_struct({every}, 'anc', __paths[i]))")).drop("__paths"))


def subtree_spans(sentences: DataFrame) -> DataFrame:
    """(doc_id, view, sent_id, ord, begin, end, size, depth): each node's subtree, and its depth (1 for a root), on whole Arrow batches.

    Heads out of range and in a circle are as for ``with_ancestors``.
    """
    rows = sentences.select("doc_id", "view", "sent_id", *[F.expr(f"nodes.{c}").alias(c) for c in ("ord", "head", "t_start", "t_end")])
    schema = StructType([rows.schema[c] for c in ("doc_id", "view", "sent_id")] + [StructField(c, IntegerType()) for c in ("ord", "begin", "end", "size", "depth")])

    def run(batches):
        for batch in batches:
            yield _spans(batch, schema.names)

    return rows.mapInArrow(run, schema)


def _spans(batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    low, high = -(1 << 31), (1 << 31) - 1
    many = pc.fill_null(pc.list_value_length(batch.column(3)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(many)), many)
    first = (np.cumsum(many) - many)[of]
    head, start, end = (pc.fill_null(batch.column(i).flatten(), empty).to_numpy(zero_copy_only=False).astype(np.int64) for i, empty in ((4, 0), (5, high), (6, low)))
    above = np.where((head >= 1) & (head <= many[of]), first + head - 1, -1)
    begin, last, size, depth = start.copy(), end.copy(), np.ones(len(of), np.int64), np.ones(len(of), np.int64)
    # all paths take a step at a time; each node tells those above it
    who = at = np.arange(len(of))
    for _ in range(int(many.max(initial=0)) + 1):
        depth[who] += head[at] > 0
        on = above[at] >= 0
        who, at = who[on], above[at[on]]
        if not len(who):
            break
        np.minimum.at(begin, at, start[who])
        np.maximum.at(last, at, end[who])
        np.add.at(size, at, 1)
    # a path that is longer than its sentence goes in a circle
    for s in np.unique(of[who]).tolist():
        here = np.flatnonzero(of == s)
        begin[here], last[here], size[here], depth[here] = high, low, 0, 1
        for n in here.tolist():
            seen, at_ = {n}, n
            for _ in range(1 << int(np.ceil(np.log2(max(len(here), 2))))):
                depth[n] += int(head[at_] > 0)
                if above[at_] < 0:
                    break
                at_ = int(above[at_])
                seen.add(at_)
            for m in seen:
                begin[m], last[m], size[m] = min(begin[m], start[n]), max(last[m], end[n]), size[m] + 1
    told = lambda x, empty: pa.array(x, pa.int32(), mask=x == empty)
    where = pa.array(of)
    return pa.RecordBatch.from_arrays([*(batch.column(i).take(where) for i in range(3)), batch.column(3).flatten(), told(begin, high), told(last, low), pa.array(size, pa.int32()), pa.array(depth, pa.int32())], names=names)


# SQL for a node's surroundings; ``n`` is the SQL of a node, each lambda takes a name of its own


def parent(n: str) -> str:
    """Null for what hangs on the technical root."""
    return f"get(nodes, {n}.head - 1)"


def children(n: str, where: str = "true", name: str = "c") -> str:
    return f"filter(nodes, {name} -> {name}.head = {n}.ord AND ({where}))"


def has_child(n: str, where: str, name: str = "c") -> str:
    return f"exists(nodes, {name} -> {name}.head = {n}.ord AND ({where}))"


def first_child(n: str, where: str, name: str = "c") -> str:
    return f"get({children(n, where, name)}, 0)"


def last_child(n: str, where: str, name: str = "c") -> str:
    return f"try_element_at({children(n, where, name)}, -1)"


def subtree(n: str, where: str = "true", name: str = "m") -> str:
    return f"filter(nodes, {name} -> array_contains({name}.anc, {n}.ord) AND ({where}))"


def begin(nodes: str) -> str:
    return f"array_min(transform({nodes}, z -> z.t_start))"


def end(nodes: str) -> str:
    return f"array_max(transform({nodes}, z -> z.t_end))"


def words(nodes: str) -> str:
    return f"array_join(transform({nodes}, z -> z.form), ' ')"


def one_of(x: str, values: list[str]) -> str:
    return f"{x} IN ({', '.join(repr(v) if chr(39) not in v else chr(34) + v + chr(34) for v in values)})"


def universal(n: str) -> str:
    """The relation before its subtype."""
    return f"split_part({n}.deprel, ':', 1)"


def feat(n: str, key: str) -> str:
    return f"coalesce({n}.feats['{key}'], '')"


def role(label: str, nodes: str, text: str | None = None) -> str:
    """A finding's part; null where there are no nodes."""
    return f"if({nodes} IS NULL OR size({nodes}) = 0, null, named_struct('label', '{label}', 'begin', {begin(nodes)}, 'end', {end(nodes)}, 'text', {text or words(nodes)}))"


def role_of(label: str, n: str) -> str:
    return f"if({n} IS NULL, null, named_struct('label', '{label}', 'begin', {n}.t_start, 'end', {n}.t_end, 'text', {n}.form))"
