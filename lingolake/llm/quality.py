"""Quality rules with risk-controlled thresholds.

Texts get counts and rates.  In each stratum (a column, such as the language) one half of the labelled rows proposes rules (a
cutoff for each rate, where it pays) and an order for them; the other half tests them in that order: rules are taken
together, one more at a time, while the exact binomial test rejects that they drop more than a share ``alpha`` of good rows, at
the level ``delta`` divided by the number of strata (Bonferroni; the fixed order needs no further correction, and as sets of
rules are tested, neither does their number).  So with confidence ``1 - delta`` no stratum loses more than ``alpha`` of its
good rows.  A stratum with too few labels to certify any rule gets none and loses nothing to these rules.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import written
from .text import ByteHash, Words, drawn, pieces, rolled, mix

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_adjacent", "n_space_words")
#: Rates of a text; a higher one is worse.
RATES = {
    "symbol_rate": ("n_symbols", "n_words"),
    "exclaim_rate": ("n_exclaim", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "adjacent_share": ("n_adjacent", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "bare_symbol_share": ("n_space_words", "n_words"),
}
#: The cutoffs that are tested, as counts of hundredths, from lenient to strict.
GRID = tuple(sorted({round(100 * 10 ** (e / 20)) for e in range(-40, 13)}, reverse=True))
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def dup_lines(text: str) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, lines with a word)."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines)), len(lines)


def counts(column: pa.Array, hashing: ByteHash) -> dict[str, np.ndarray]:
    """The counts of each text of a column; nulls count as empty."""
    w = Words(column)
    data, off = w.data, w.offsets
    h = hashing.words(data, w.starts, w.ends)
    n = len(w.counts)
    owner = w.owner()
    repeat = np.zeros(len(h) + 1, np.int64)
    at = w.windows(WINDOW)
    if len(at):
        key = mix(rolled(h, WINDOW, 77)[at] + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        if same.any():
            twice = np.zeros(len(at), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            np.add.at(repeat, at[twice], 1)
            np.add.at(repeat, at[twice] + WINDOW, -1)
    covered = np.cumsum(repeat)[:-1] > 0
    adjacent = np.zeros(len(h), bool)
    if len(h) > 1:
        adjacent[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    upper = (data >= 65) & (data <= 90)
    # x80-x9E after xC3: upper-case letters of Latin-1
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    symbol = SYMBOLS[data]
    lines = [dup_lines(t) if t and "\n" in t else (0, int(bool(t and t.strip(" \t\x0b\x0c\r")))) for t in column.to_pylist()]
    alone = np.zeros(len(h), bool)
    if len(h):
        alone = (w.ends - w.starts == 1) & symbol[w.starts]
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _per_text(w.solid & ((data & 0xC0) != 0x80), off),
        "n_symbols": _per_text(symbol, off),
        "n_dup_lines": np.array([x[0] for x in lines], np.int64),
        "n_repeat_words": _per_text(covered, w.doc),
        "n_lines": np.array([x[1] for x in lines], np.int64),
        "n_upper": _per_text(upper, off),
        "n_exclaim": _per_text(data == 33, off),
        "n_adjacent": _per_text(adjacent, w.doc),
        "n_space_words": _per_text(alone, w.doc),
    } if n else {c: np.zeros(0, np.int64) for c in COUNTS}


def measured(docs: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """The ``keep`` columns with the counts of each text (null: an empty text).  No shuffle."""
    keep = [c for c in keep if c not in COUNTS]
    source = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), *(f"{c} long" for c in COUNTS)])

    seed = drawn()

    def run(batches):
        hashing = ByteHash(seed)
        for batch in pieces(batches, "__text"):
            found = counts(batch.column(batch.num_columns - 1), hashing)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(found[c]) for c in COUNTS)], names=[*keep, *COUNTS])

    return source.mapInArrow(run, schema)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable, exactly (a sum of its terms)."""
    if k >= n:
        return 1.0
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def proposed(good: list[int], bad: list[int], price: float) -> tuple[int, float] | None:
    """(grid index, gain) of the cutoff of GRID that pays most, given how many good and bad rows lie above each; None if none pays."""
    gain, at = max(((b - price * g, -i) for i, (g, b) in enumerate(zip(good, bad))), default=(0.0, 0))
    return (-at, gain) if gain > 0 else None


def certified(rejected: list[int], n: int, alpha: float, level: float) -> int:
    """How many rules of a fixed order may be used together, given how many of n good rows each rejects that none before it does."""
    total = 0
    for i, g in enumerate(rejected):
        total += g
        # P(no more than these rejected | the true rate is alpha): the first failure ends the fixed sequence
        if not n or binomial_cdf(total, n, alpha) > level:
            return i
    return len(rejected)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


RULES = pa.schema([("stratum", pa.string()), ("place", pa.int32()), ("rate", pa.string()), ("cutoff", pa.int64())])
TESTED = pa.schema([*RULES, ("n_good", pa.int64()), ("good_rejected", pa.int64())])


def rules(learn: DataFrame, *, price: float) -> DataFrame:
    """(stratum, place, rate, cutoff): for each rate the cutoff that pays most on the rows (stratum, good, counts), in the order
    in which they are to be tested, the highest gain first.  One aggregation; then a row a stratum."""
    level = F.array(*[F.lit(x) for x in GRID])

    def above(a: str, b: str):
        return F.size(F.filter(level, lambda cut: F.col(a) * 100 > cut * F.col(b)))

    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), above(a, b).alias("above")) for r, (a, b) in RATES.items()]))
    table = (
        learn.select("stratum", "good", bins.alias("x"))
        .groupBy("stratum", "x.rate", "x.above").agg(F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("b"))
        .groupBy("stratum").agg(F.collect_list(F.struct("rate", "above", "g", "b")).alias("bins"))
    )

    def propose(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                found = []
                for rate in RATES:
                    # a row with ``above`` cutoffs below its rate is above the last ``above`` of them
                    g, b = [0] * len(GRID), [0] * len(GRID)
                    for x in r["bins"]:
                        if x["rate"] == rate:
                            for i in range(len(GRID) - x["above"], len(GRID)):
                                g[i] += x["g"]
                                b[i] += x["b"]
                    if (best := proposed(g, b, price)) is not None:
                        found.append((-best[1], rate, GRID[best[0]]))
                rows += [(r["stratum"], i, rate, cutoff) for i, (_, rate, cutoff) in enumerate(sorted(found))]
            yield _table(rows, RULES)

    return table.mapInArrow(propose, "stratum string, place int, rate string, cutoff long")


def thresholds(holdout: DataFrame, *, alpha: float, delta: float, price: float) -> DataFrame:
    """(stratum, place, rate, cutoff, n_good, good_rejected): the certified rules; rows with a rate above a cutoff go.

    ``holdout`` has a row a labelled document: key, stratum, good, counts.  Its halves (by a hash of the key) are used once each:
    one proposes rules and their order, the other tests them.
    """
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    found = written(rules(holdout.filter(half == 0), price=price), "quality-rules")
    test = holdout.filter(half == 1)
    strata = holdout.select("stratum").distinct().count() or 1
    # a stratum has a rule a rate at most
    listed = found.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("place", "rate", "cutoff"))).alias("rules"))
    rejects = " ".join(f"WHEN '{r}' THEN {a} * 100 > x.cutoff * {b}" for r, (a, b) in RATES.items())
    first = test.join(listed, "stratum").select("stratum", "good", F.expr(f"coalesce(get(filter(rules, x -> CASE x.rate {rejects} END), 0).place, 1000)").alias("place"))
    counts = first.filter("good").groupBy("stratum", "place").agg(F.count(F.lit(1)).alias("g")).groupBy("stratum").agg(F.collect_list(F.struct("place", "g")).alias("counts"))

    def test_in_order(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                told = sorted((x["place"], x["rate"], x["cutoff"]) for x in r["rules"])
                by_place = {x["place"]: x["g"] for x in r["counts"] or []}
                n = sum(by_place.values())
                many = certified([by_place.get(place, 0) for place, _, _ in told], n, alpha, delta / strata)
                rows += [(r["stratum"], *x, n, by_place.get(x[0], 0)) for x in told[:many]]
            yield _table(rows, TESTED)

    return listed.join(counts, "stratum", "left").mapInArrow(test_in_order, "stratum string, place int, rate string, cutoff long, n_good long, good_rejected long")


def judge(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", stratum: str = "lang", label: str = "quality", alpha: float = 0.03, delta: float = 0.05, price: float = 20.0, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Each row's ``key`` with its counts, ``base_failed``, ``kept`` and ``failed`` (names of the rates that rejected it).

    ``labels`` has ``key`` and ``label`` (1 good, 0 bad); a key labelled more than once counts as bad if any label is;
    null keys or labels are left out.  A key is one sample, however many rows have it (the least of them counts).  A null
    stratum is a stratum of its own.  A null text is empty (and so fails the base rule on words).  Repeated rows come back
    as often as they came.
    """
    counted = written(measured(docs.select(F.col(key), F.coalesce(F.col(stratum).cast("string"), F.lit("\x00")).alias("__stratum"), F.col(text)), text=text, keep=[key, "__stratum"]), "quality")
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key)).agg((F.min(label) == 1).alias("__good"))
    samples = counted.join(known, key).groupBy(F.col(key).alias("key")).agg(F.min(F.struct("__stratum", "__good", *COUNTS)).alias("x"))
    holdout = written(samples.select("key", F.col("x.__stratum").alias("stratum"), F.col("x.__good").alias("good"), *[f"x.{c}" for c in COUNTS]), "quality-holdout")
    cutoffs = thresholds(holdout, alpha=alpha, delta=delta, price=price)
    wide = cutoffs.groupBy("stratum").pivot("rate", list(RATES)).agg(F.first("cutoff"))
    # a certified stratum has hundreds of labelled rows at least, so this is small; the optimizer decides on a broadcast by size
    out = counted.join(wide.withColumnRenamed("stratum", "__stratum"), "__stratum", "left")
    failed = F.filter(F.array(*[F.when(F.col(a) * 100 > F.col(r) * F.col(b), F.lit(r)) for r, (a, b) in RATES.items()]), lambda x: x.isNotNull())
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    return out.select(key, *COUNTS[:5], base.alias("base_failed"), (~base & (F.size(failed) == 0)).alias("kept"), failed.alias("failed"))
