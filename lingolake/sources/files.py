"""Annotation files: XMI in and out, gold examples, metrics, and a service that annotates over HTTP."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

ATTRIBUTE = r"([A-Za-z_][\w:.-]*)=\"([^\"]*)\""
ELEMENT = r"<([A-Za-z_][\w.-]*):([A-Za-z_][\w.-]*)((?:\s+[A-Za-z_][\w:.-]*=\"[^\"]*\")*)\s*/?>"
PLAIN = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#10;", "\n"), ("&#13;", "\r"), ("&#9;", "\t"), ("&amp;", "&")]


def _plain(x: str) -> str:
    for coded, sign in PLAIN:
        sign = sign.replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t").replace("'", "\\'")
        x = f"replace({x}, '{coded}', '{sign}')"
    return x


def read_xmi(spark: SparkSession, path: str, *, failed: bool = False) -> DataFrame:
    """Feature structures of XMI files, one a row: file, prefix, type, id, sofa, begin, end, features (all attributes).

    A folder gives its *.xmi files, without those below it.  Types aren't checked (what a reader doesn't know it doesn't
    ask for), and a file that isn't XMI gives no rows; with ``failed`` the names of such files are returned instead.
    A path without any such file is an error.
    """
    pattern = path if path.endswith(".xmi") else path.rstrip("/") + "/*.xmi"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target):
        raise FileNotFoundError(f"no XMI files: {path}")
    texts = spark.read.text(pattern, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    rows = texts.withColumn("all", F.regexp_extract_all("value", F.lit(ELEMENT), F.lit(0)))
    if failed:
        return rows.filter(~F.col("value").contains("xmi:XMI")).select("file")
    rows = rows.filter(F.col("value").contains("xmi:XMI")).select("file", F.explode("all").alias("element"))
    pairs = F.expr(f"map_from_entries(transform(arrays_zip(regexp_extract_all(element, '{ATTRIBUTE.replace(chr(92), chr(92) * 2)}', 1) k, regexp_extract_all(element, '{ATTRIBUTE.replace(chr(92), chr(92) * 2)}', 2) v), x -> struct(x.k, {_plain('x.v')})))".replace("arrays_zip(", "zip_with(").replace(" k, ", ", ").replace(" v), x ->", ", (k, v) -> named_struct('k', k, 'v', v)), x ->"))
    rows = rows.select("file", F.regexp_extract("element", ELEMENT, 1).alias("prefix"), F.regexp_extract("element", ELEMENT, 2).alias("type"), pairs.alias("features")).filter("prefix <> 'xmi' OR type <> 'XMI'")
    number = lambda k: F.col("features").getItem(k).try_cast("int")
    return rows.select("file", "prefix", "type", number("xmi:id").alias("id"), F.col("features").getItem("sofa").alias("sofa"), number("begin").alias("begin"), number("end").alias("end"), "features")


def _coded(x: str) -> str:
    for coded, sign in reversed(PLAIN):
        sign = sign.replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t").replace("'", "\\'")
        x = f"replace({x}, '{sign}', '{coded}')"
    return x


def write_xmi(sofas: DataFrame, annotations: DataFrame, path: str) -> DataFrame:
    """A document an XMI file under ``path``: sofas (doc_id, view, text) and annotations (doc_id, view, kind, begin, end, description,
    category, label, and suggestion and certainty, if there).  Returns (doc_id, file).

    A document's annotations come together in one task, are numbered there, so equal ones stay apart, and a file appears
    under its name when it is whole.  It is written to a new path, never over what it was read from.
    """
    attribute = lambda name, column: f"if({column} IS NULL, '', concat(' {name}=\"', {_coded(column)}, '\"'))"
    for column, kind in (("suggestion", "string"), ("certainty", "double")):
        if column not in annotations.columns:
            annotations = annotations.withColumn(column, F.lit(None).cast(kind))
    action = f"if(x.suggestion IS NULL, '', concat('<custom:SuggestedAction xmi:id=\"', 2 * i + 1001, '\"', {attribute('replacement', 'x.suggestion')}, ' certainty=\"', coalesce(x.certainty, 1.0), '\"/>\n  '))"
    refers = "if(x.suggestion IS NULL, '', concat(' suggestions=\"', 2 * i + 1001, '\"'))"
    line = f"concat({action}, '<custom:', x.kind, ' xmi:id=\"', 2 * i + 1000, '\" sofa=\"', x.view, '\" begin=\"', x.begin, '\" end=\"', x.end, '\"', {attribute('description', 'x.description')}, {attribute('category', 'x.category')}, {attribute('text', 'x.label')}, {refers}, '/>')"
    held = annotations.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("view", "begin", "end", "kind", "description", "category", "label", "suggestion", "certainty"))).alias("held"))
    views = sofas.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.expr(f"concat('<cas:Sofa xmi:id=\"', view, '\" sofaID=\"', view, '\" mimeType=\"text/plain\" sofaString=\"', {_coded('text')}, '\"/>')"))).alias("sofas"))
    head = '<?xml version="1.0" encoding="UTF-8"?>\\n<xmi:XMI xmlns:xmi="http://www.omg.org/XMI" xmlns:cas="http:///uima/cas.ecore" xmlns:custom="http:///custom.ecore" xmi:version="2.0">'
    whole = F.expr(f"concat('{head}\\n  ', array_join(concat(sofas, coalesce(transform(held, (x, i) -> {line}), cast(array() AS array<string>))), '\\n  '), '\\n</xmi:XMI>')")
    rows = views.join(held, "doc_id", "left").select("doc_id", whole.alias("value"))

    def run(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
        system.create_dir(base, recursive=True)
        for batch in batches:
            names = []
            for doc, value in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"{base.rstrip('/')}/{doc}.xmi"
                part = f"{name}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(part) as out:
                    out.write(value.encode("utf-8", "surrogatepass"))
                system.move(part, name)
                names.append(name)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string())], names=["doc_id", "file"])

    from ..shared import new_dir

    manifest = new_dir(sofas.sparkSession, "xmi-written")
    rows.mapInArrow(run, "doc_id long, file string").write.parquet(manifest)
    return sofas.sparkSession.read.schema("doc_id long, file string").parquet(manifest)


GOLD = "id string, text string, category string, is_vpe boolean, ellipsis_site string"


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold examples of a JSON file: a list, or an object with the list under ``examples``."""
    whole = spark.read.text(path, wholetext=True)
    fields = GOLD.replace(" ", ":").replace(",:", ",")
    both = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{fields}>>")).otherwise(F.from_json("value", f"examples array<struct<{fields}>>")["examples"])
    return whole.select(F.explode(both).alias("x")).select("x.*")


def write_metrics(report: DataFrame, path: str, examples: DataFrame | None = None) -> None:
    """The report as JSON under ``path``; with ``examples``, they too, a line each, under ``path`` with ``-examples`` behind it."""
    report.write.json(path)
    if examples is not None:
        examples.write.json(path.rstrip("/") + "-examples")


def http_annotator(url: str, token: str | None = None, timeout: float = 120.0) -> Callable[[Iterator], Iterator]:
    """For ``mapInPandas`` on (doc_id, payload): posts each payload (JSON text) and gives (doc_id, response); an error status fails the task."""

    def run(frames):
        import urllib.request

        for frame in frames:
            answers = []
            for payload in frame["payload"]:
                request = urllib.request.Request(url, json.dumps(json.loads(payload)).encode(), {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {token}"} if token else {}))
                with urllib.request.urlopen(request, timeout=timeout) as reply:
                    answers.append(reply.read().decode())
            yield frame[["doc_id"]].assign(response=answers)

    return run
