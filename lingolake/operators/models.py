"""What model-backed annotators decide, given the models' scores: the native part of spelling, discourse units and coreference."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F


def decide_swap(scored: DataFrame, *, keys: list[str], magnitude: float = 10.0, min_certainty: float = 0.0) -> DataFrame:
    """Real-word errors: (keys, surface, candidate, score, rank) to (keys, surface, suggestion, certainty).

    The word's own score is that of the last candidate that equals it in any case (0 if none).  The best other one
    (the first on ties) must score ``magnitude`` times as much; certainty is the decimal logarithm of the ratio, or
    ``magnitude`` where the word itself scores nothing.
    """
    own = F.lower("candidate") == F.lower("surface")
    best = scored.groupBy(*keys, "surface").agg(
        F.max_by(F.when(own, F.col("score")), F.when(own, F.col("rank"))).alias("mine"),
        F.max_by(F.when(~own, F.struct("candidate", "score")), F.when(~own, F.struct("score", -F.col("rank")))).alias("top"),
    )
    mine = F.coalesce("mine", F.lit(0.0))
    certainty = F.when(mine > 0, F.log10(F.col("top.score") / F.when(mine > 0, mine))).otherwise(F.lit(float(magnitude)))
    out = best.withColumn("certainty", certainty).filter((F.col("top.score") >= mine * magnitude) & (F.col("certainty") >= min_certainty))
    first = F.substring("surface", 1, 1)
    word = F.col("top.candidate")
    cased = F.when((first == F.upper(first)) & (first != F.lower(first)), F.concat(F.upper(F.substring(word, 1, 1)), F.expr("substring(top.candidate, 2)"))).otherwise(word)
    return out.select(*keys, "surface", cased.alias("suggestion"), "certainty")


def discourse_units(sentences: str = "sentence", labels: str = "labels", shift: str = "0") -> str:
    """SQL for a sentence's discourse units (array of begin, end): a word labelled 1, and the first one, opens a unit; a missing label is 0."""
    # the gap before each word and the word itself, found once; acc.at is where the gap begins
    pairs = f"""zip_with(regexp_extract_all({sentences}, '(?Us)(\\\\s*)(\\\\S+)', 1), regexp_extract_all({sentences}, '(?Us)(\\\\s*)(\\\\S+)', 2), (g, w) -> named_struct('g', length(g), 'w', length(w)))"""
    opens = f"acc.i = 0 OR coalesce(get({labels}, acc.i), 0) = 1"
    # ends of words, and begins of those that open a unit; a unit ends where the last word before the next unit ends
    fold = f"""aggregate({pairs}, named_struct('at', 0, 'i', 0, 'begins', cast(array() AS array<int>), 'ends', cast(array() AS array<int>)),
        (acc, x) -> named_struct('at', acc.at + x.g + x.w, 'i', acc.i + 1, 'begins', if({opens}, array_append(acc.begins, {shift} + acc.at + x.g), acc.begins), 'ends', if(({opens}) AND acc.i > 0, array_append(acc.ends, {shift} + acc.at), acc.ends)),
        acc -> zip_with(acc.begins, if(acc.i = 0, acc.ends, array_append(acc.ends, {shift} + acc.at)), (b, e) -> named_struct('begin', b, 'end', e)))"""
    return fold


def truncated(labels: str, subwords: str, most: int = 512, special: int = 2) -> str:
    """SQL for the labels that a model with room for ``most`` subwords can give: those of the words that fit, given each word's number of subwords."""
    room = f"aggregate({subwords}, named_struct('left', {most - special}, 'n', 0), (acc, k) -> if(acc.left >= k, named_struct('left', acc.left - k, 'n', acc.n + 1), named_struct('left', -1, 'n', acc.n))).n"
    return f"slice({labels}, 1, {room})"


def discourse_layer(views: DataFrame, sentences: DataFrame) -> DataFrame:
    """(doc_id, view, begin, end): the discourse units of sentences (doc_id, view, begin, sentence, labels) at their places in the view.
    Blank sentences have none; a view without sentences is an error."""
    rows = views.select("doc_id", "view").distinct().join(sentences, ["doc_id", "view"], "left")
    rows = rows.withColumn("begin", F.when(F.col("sentence").isNull(), F.raise_error(F.concat(F.lit("no sentences in view "), "view"))).otherwise(F.col("begin")))
    return rows.select("doc_id", "view", F.explode(F.expr(discourse_units(shift="begin"))).alias("u")).select("doc_id", "view", "u.begin", "u.end")


def coreference_tokens(sentences: DataFrame, *, payload: bool = True) -> DataFrame:
    """(doc_id, view, payload, tokens): the request with token lists by sentence, and each token's (begin, end) in the same, flat order.
    A view's sentences are one request, so they come together (in order, whatever their partitions).  What is shuffled is a list of
    numbers for the places and, unless only these are asked for (no ``payload``), one of forms."""
    told = ["sent_id", *([F.expr("nodes.form").alias("forms")] if payload else []), F.expr("nodes.t_start").alias("begins"), F.expr("nodes.t_end").alias("ends")]
    rows = sentences.groupBy("doc_id", "view").agg(F.array_sort(F.collect_list(F.struct(*told))).alias("s"))
    tokens = F.expr("flatten(transform(s, x -> zip_with(x.begins, x.ends, (b, e) -> named_struct('begin', b, 'end', e))))").alias("tokens")
    return rows.select("doc_id", "view", *([F.to_json(F.struct(F.expr("transform(s, x -> x.forms)").alias("tokens"))).alias("payload")] if payload else []), tokens)


def coreference_text(documents: DataFrame) -> DataFrame:
    """(doc_id, view, payload): the request with the text as it is (null: an empty one)."""
    return documents.select("doc_id", "view", F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("tokens"))).alias("payload"))


def found_tokens(tokens: str, text: str) -> str:
    """SQL for the places of an answer's tokens in the text, one after the other; one that isn't there takes its length from the cursor on."""
    at = f"if(locate(tok_, {text}, acc.at + 1) = 0, acc.at, locate(tok_, {text}, acc.at + 1) - 1)"
    return f"""aggregate({tokens}, named_struct('at', 0, 'out', cast(array() AS array<struct<begin:int,end:int>>)),
        (acc, tok_) -> named_struct('at', {at} + length(tok_), 'out', array_append(acc.out, named_struct('begin', {at}, 'end', {at} + length(tok_))))).out"""


def masked(sentences: DataFrame, confusion: DataFrame, mask: str = "[MASK]") -> DataFrame:
    """(doc_id, view, sent_id, ord, surface, masked, candidates): each token that a confusion set (word, candidates) is for, and its sentence's
    tokens, joined by spaces, with the mask at that token only.  A scorer gives (candidate, score, rank) for ``decide_swap``.

    The sets, a word list, are broadcast: sentences stay where they are.
    """
    rows = sentences.select("doc_id", "view", "sent_id", "nodes", F.explode("nodes").alias("n"))
    sets = confusion.select(F.lower("word").alias("__word"), "candidates")
    hits = rows.withColumn("__word", F.lower("n.form")).join(F.broadcast(sets), "__word")
    text = F.expr(f"array_join(transform(nodes, x -> if(x.ord = n.ord, '{mask}', x.form)), ' ')")
    return hits.select("doc_id", "view", "sent_id", F.col("n.ord").alias("ord"), F.col("n.form").alias("surface"), text.alias("masked"), "candidates")


def mentions(clusters: DataFrame, tokens: DataFrame) -> DataFrame:
    """Coreference: (doc_id, clusters: lists of lists of first and last token, inclusive) and (doc_id, place, begin, end) to phrases
    labelled with the cluster's number from 1; mentions out of range are passed over, a document without clusters is an error."""
    rows = clusters.withColumn("clusters", F.when(F.size("clusters") > 0, F.col("clusters")).otherwise(F.raise_error(F.lit("no clusters")).cast("array<array<array<int>>>")))
    rows = rows.select("doc_id", F.posexplode("clusters").alias("n", "cluster")).select("doc_id", (F.col("n") + 1).cast("string").alias("label"), F.explode("cluster").alias("m"))
    rows = rows.select("doc_id", "label", F.col("m")[0].alias("first"), F.col("m")[1].alias("last"))
    a = tokens.select("doc_id", F.col("place").alias("first"), F.col("begin"))
    b = tokens.select("doc_id", F.col("place").alias("last"), F.col("end"))
    return rows.join(a, ["doc_id", "first"]).join(b, ["doc_id", "last"]).select("doc_id", "label", "begin", "end")


def deletions(word: str) -> str:
    """SQL for the word and all that one deletion leaves of it."""
    return f"array_distinct(concat(array({word}), transform(sequence(1, greatest(length({word}), 1)), i -> concat(substring({word}, 1, i - 1), substring({word}, i + 1)))))"


def spelling_candidates(words: DataFrame, wordlist: DataFrame) -> DataFrame:
    """(word, candidate, n, rank): entries (word, n) within one edit of each unknown word, the most frequent first.

    Words within one edit share a form that one deletion or none leaves of both, so this is an equi-join and no
    comparison of all with all.
    """
    known = wordlist.select(F.col("word").alias("candidate"), "n")
    odd = words.select("word").distinct().join(known.select(F.col("candidate").alias("word")), "word", "left_anti")
    left = odd.select("word", F.explode(F.expr(deletions("word"))).alias("form"))
    right = known.select("candidate", "n", F.explode(F.expr(deletions("candidate"))).alias("form"))
    pairs = left.join(right, "form").select("word", "candidate", "n").distinct().filter(F.levenshtein("word", "candidate") == 1)
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy(F.desc("n"), "candidate")))


def scored_by(rows: DataFrame, scorer: Callable, schema: str) -> DataFrame:
    """Runs a model over Arrow batches (``scorer`` takes and gives iterators of pandas frames); models are loaded once a worker."""
    return rows.mapInPandas(scorer, schema)
