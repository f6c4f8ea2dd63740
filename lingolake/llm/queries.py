"""The queries of this subpackage's operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabularies() -> tuple[str, ...]:
    """Files that rank words (see ``secrets.frequent_words``)."""
    return tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_path("byte_bpe_multi_50k.tiktoken")


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import dedup

    return dedup(_table(spark, sf_dir, "documents"), with_text=False)


OP1_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
     k AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)),
     m AS (SELECT k, min(doc_id) AS first FROM k GROUP BY k),
     gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM k JOIN m USING (k), range(13) r(j) WHERE first < doc_id),
     word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM t),
     kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.pos) AS kept, count(*) AS n FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.pos = word.pos WHERE gone.pos IS NULL GROUP BY word.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept ON kept.doc_id = t.doc_id
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive, summary

    return summary(archive(_table(spark, sf_dir, "pages")))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     w AS (SELECT html, max(page_id) AS winner FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN winner IS NULL OR winner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM p LEFT JOIN w ON p.html = w.html
"""


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import classes_of

    return classes_of(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


OP3_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM t WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
     near AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
     link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
     reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
     least_ AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT t.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(t.doc_id, coalesce(c, t.doc_id)) AS component_id, least(t.doc_id, coalesce(c, t.doc_id)) = t.doc_id AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN least_ ON a = t.doc_id
"""


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan

    found = scan(_table(spark, sf_dir, "documents"), keep=["doc_id"], vocabularies=vocabularies(), redacted=False)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_guess")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_backend import encode

    return encode(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"], with_ids=False)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import matches

    return matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, score, train

    docs = _table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_tree import extract

    out = extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    out = judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.withColumn("failed", F.array_join("failed", ","))


def op10_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sstable import read_shards, write_shards

    shards = write_shards(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return read_shards(shards).withColumnRenamed("key", "doc_id")


QUERIES = {"op1_substring": op1_substring, "op2_warc": op2_warc, "op3_minhash": op3_minhash, "op4_secrets": op4_secrets, "op5_sentencepiece": op5_sentencepiece, "op6_decontaminate": op6_decontaminate, "op7_toxicity": op7_toxicity, "op8_html": op8_html, "op9_quality": op9_quality, "op10_sstable": op10_sstable}
ORACLES: dict[str, str] = {"op1_substring": OP1_SQL, "op2_warc": OP2_SQL, "op3_minhash": OP3_SQL}


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op4_secrets`` that SQL can express."""
    return op4_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = (("assign", _ASSIGN, "length(regexp_extract(h, '{p}', 2)) >= 6"), ("access", "AKIA[A-Z0-9]+", "length(h) >= 20"), ("hex", "[0-9a-f]+", "length(h) >= 24"))
SECRETS_BASE_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), "
    + ", ".join(
        f"""{kind}_ AS (SELECT doc_id, {n} AS k, '{kind}' AS kind, h, sum(length(g) + length(h)) OVER (PARTITION BY doc_id ORDER BY i) AS stop, {keep.format(p=p)} AS good
        FROM (SELECT doc_id, unnest(hits) AS h, unnest(string_split_regex(t, '{p}')[:len(hits)]) AS g, generate_subscripts(hits, 1) AS i FROM (SELECT *, regexp_extract_all(t, '{p}') AS hits FROM d) WHERE len(hits) > 0))"""
        for n, (kind, p, keep) in enumerate(_KINDS)
    )
    + """, spans AS (SELECT doc_id, k, kind, CAST(stop - length(h) AS BIGINT) AS b, CAST(stop AS BIGINT) AS e FROM (FROM assign_ UNION ALL FROM access_ UNION ALL FROM hex_) WHERE good),
    told AS (SELECT doc_id, count_if(k = 0) AS a, count_if(k = 1) AS c, count_if(k = 2) AS x, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) AS base FROM spans GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access, CAST(coalesce(x, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256 FROM d LEFT JOIN told ON told.doc_id = d.doc_id"""
)


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op9_quality`` that SQL can express."""
    return op9_quality(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUALITY_BASE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
     k AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
     twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM k) WHERE n > 1),
     covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + j AS pos FROM twice, range(8) r(j)) GROUP BY doc_id),
     lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(w) < 20 OR 100 * coalesce(covered.n, 0) > 30 * len(w) AS base_failed
FROM t LEFT JOIN covered ON covered.doc_id = t.doc_id LEFT JOIN lines ON lines.doc_id = t.doc_id
"""

QUERIES |= {"secrets_base": secrets_base, "quality_base": quality_base}
ORACLES |= {"secrets_base": SECRETS_BASE_SQL, "quality_base": QUALITY_BASE_SQL}
