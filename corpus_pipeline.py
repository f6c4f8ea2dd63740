"""A pipeline that turns raw documents into token ids, of the operators in lingolake.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lingolake.llm import decontaminate, neardup, secrets, sentencepiece_backend, toxicity
from lingolake.llm.queries import tokenizer_path, vocabularies
from lingolake.llm.store import written
from lingolake.session import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents with this score of toxicity or more go.
TOXIC = 0.7


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the machine is fitted on the labelled documents that aren't held out."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    docs = _columns(docs)
    scored = toxicity.score(docs, toxicity.train(docs, labels), keep=[*COLUMNS], out="__score")
    return _columns(scored.filter(F.col("__score") < TOXIC))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    ship(spark)
    docs = _columns(docs)
    groups = neardup.classes_of(docs, shingle=5, percent=80)
    gone = written(groups.filter(~F.col("kept")).select("doc_id").distinct(), "pipeline-copies")
    # documents without an id are in no group and stay
    return _columns(docs.join(gone, "doc_id", "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return _columns(decontaminate.clean(_columns(docs), benchmark))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    ship(spark)
    found = secrets.scan(_columns(docs), keep=[*COLUMNS], vocabularies=vocabularies())
    text = F.coalesce("redacted", "text")
    return _columns(found.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_assign") + F.col("n_access") + F.col("n_hex") + F.col("n_guess") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    ship(spark)
    return sentencepiece_backend.encode(_columns(docs), tokenizer_path("piece_bpe_32k.model"), keep=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", encode),
]

#: SQL can't express the fitted machine, the signatures or the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
