"""Secret scans.

Three base kinds are found by pattern.  On top of them, values in a credential context (a key such as
``passphrase:``, ``pwd =`` or the user part of a URL) are rated by guess cost: the cheapest way to build the value
from words, dates, repeats, keyboard or alphabet walks and brute-force spans, found by dynamic programming.
Values that cost at least ``min_log10`` decimal digits of guesses become spans of kind ``guess``.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Keys whose values are rated, in either case.  The last group that is set is the value: of a quoted one all up to the closing
#: quote (in the line), else a run of code points other than white space.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?|auth)["']?\x20*[:=]\x20*"""
    r"""(?:"((?:[^"\\\r\n]|\\[^\r\n]){6,})"|'((?:[^'\\\r\n]|\\[^\r\n]){6,})'|„([^“”\r\n]{6,})[“”]|“([^”\r\n]{6,})”|«([^»\r\n]{6,})»|["'„“«]?([^"""
    + SPACE + r"""]{6,}))""", re.I | re.A
)
URL_LOGIN = re.compile(r"[a-z][a-z0-9+.-]*://[^\s/:@]+:([^\s/@]{6,})@", re.A)

# Frequent words in passwords, most frequent first.
COMMON = tuple(
    """password love secret admin welcome monkey dragon master login princess sunshine shadow football baseball superman
    batman michael jordan hunter ranger buster soccer killer george andrew charlie thomas jessica pepper daniel access
    joshua maggie starwars silver william dallas yankees ashley amanda orange biteme freedom computer thunder nicole
    ginger heather hammer summer winter spring autumn corvette taylor austin merlin matrix cookie chicken please test
    user root guest default changeme example token key private public server database system service account the and
    for you that this with from have hello world money happy lucky angel baby girl flower purple yellow green black
    white blue red cat dog fish bird tiger lion eagle""".split()
)
# Rows of keyboards and runs of the alphabet and digits.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "qwertzuiop", "yxcvbnm", "azertyuiop", "qsdfghjklm", "wxcvbn", "abcdefghijklmnopqrstuvwxyz", "0123456789", "1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm")
LEET = str.maketrans("4@310$57!", "aaeiossti")
DATE = re.compile(r"(?:19|20)\d\d(?:([-./_]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-./_]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d")


@lru_cache(maxsize=4)
def frequent_words(*paths: str) -> tuple[str, ...]:
    """Words by how early the vocabularies (files of "base64 rank" lines) learnt them, which is about by frequency: of each
    token that is a space and three letters or more, the letters, lower-cased."""
    found: dict[str, int] = {}
    for path in paths:
        with open(path, "rb") as f:
            for line in f:
                token, _, rank = line.partition(b" ")
                word = base64.b64decode(token).decode("utf-8", "ignore")
                if word[:1] == " " and len(word) > 3 and word[1:].isalpha():
                    word = word[1:].replace("İ", "i").lower()
                    found[word] = min(found.get(word, 1 << 62), int(rank))
    return tuple(sorted(found, key=lambda w: (found[w], w)))


class Runs:
    """Spans of one kind that go on from where they begin to the end of a run, at a cost that grows with the logarithm of their
    steps: the cheapest way to each end, for all beginnings at once.

    A span that began earlier falls behind a later one by less and less, so once it is as cheap it stays so: a list of those
    that are still the cheapest somewhere is kept, for each place within a step; it rarely holds more than two or three.
    """

    __slots__ = ("step", "fewest", "ends", "open")

    def __init__(self, step: int, fewest: int, ends: list[int]):
        self.step, self.fewest, self.ends = step, fewest, ends
        #: by place within a step: (begin, cost without the logarithm, end of the run)
        self.open: dict[int, list[tuple[int, float, int]]] = {}

    def begin(self, i: int, cost: float) -> bool:
        end = self.ends[i]
        if end < i + self.fewest * self.step:
            return False
        held = self.open.setdefault(i % self.step, [])
        mine, steps = cost + math.log10(self.fewest), i // self.step + self.fewest
        if any(e >= end and c + math.log10(steps - b // self.step) <= mine for b, c, e in held):
            return False
        held.append((i, cost, end))
        return True

    def cheapest(self, j: int) -> float:
        held = self.open.get(j % self.step)
        if not held:
            return math.inf
        best, left = math.inf, []
        for b, cost, end in held:
            if end < j:
                continue
            steps = (j - b) // self.step
            now = cost + math.log10(steps) if steps else math.inf
            if steps and any(e >= end and f <= now for _, _, e, f in left):
                continue
            left.append((b, cost, end, now))
            if steps >= self.fewest and now < best:
                best = now
        if left:
            if len(left) < len(held):
                self.open[j % self.step] = [x[:3] for x in left]
        else:
            del self.open[j % self.step]
        return best


class GuessCost:
    """log10 of the guesses that the cheapest segmentation of a value takes.

    Each span adds the logarithm of its own guesses, and each boundary a constant for not knowing the structure.
    Spans are: words (the logarithm of the rank, more in capitals or with digits for letters), dates, walks over neighbours
    on a keyboard or in the alphabet, repeats of any unit, both of any length that the value allows, and brute force.  What is
    below the limit is exact.  As a character costs a digit or more, a unit has fewer characters than the limit has digits;
    so the work is in proportion to the value's length (see ``Runs``).
    """

    BOUNDARY, WALK = 0.5, 1.7

    def __init__(self, words: Iterable[str] = COMMON):
        self.rank = {}
        for word in words:
            if len(word) >= 3:
                self.rank.setdefault(word.lower(), len(self.rank) + 1)
        #: by first three letters, the longest word with them
        self.longest: dict[str, int] = {}
        for word in self.rank:
            self.longest[word[:3]] = max(len(word), self.longest.get(word[:3], 0))
        self.next = {a + b for row in ROWS for line in (row, row[::-1]) for a, b in zip(line, line[1:])}

    @staticmethod
    def _pool(ch: str) -> float:
        return math.log10(10 if ch.isdigit() else 26 if ch.isalpha() and ch.isascii() else 33 if ch.isascii() else 1000)

    def log10(self, value: str, limit: float = math.inf) -> float:
        """The least cost; from ``limit`` on, any number that isn't below it."""
        bound = 8.0
        while True:
            found = self._below(value, min(bound, limit))
            if found < bound or bound >= limit:
                return found
            bound *= 2

    def _words(self, value: str, plain: str, leet: str, i: int) -> Iterator[tuple[int, float]]:
        """Ends and costs of the words that begin at i."""
        most = max(self.longest.get(plain[i : i + 3], 0), self.longest.get(leet[i : i + 3], 0))
        for j in range(i + 3, min(len(value), i + most) + 1):
            for form in (plain[i:j], leet[i:j]):
                if (rank := self.rank.get(form)) is not None:
                    yield j, math.log10(rank + 1) + 0.3 * (form != plain[i:j]) + 0.3 * (value[i:j] != plain[i:j])

    def _runs(self, plain: str, value: str, limit: float) -> tuple[Runs, list[Runs]]:
        """Walks, and repeats by the unit's length."""
        n = len(value)
        ends = [n] * n
        for i in range(n - 2, -1, -1):
            ends[i] = ends[i + 1] if plain[i : i + 2] in self.next else i + 1
        codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
        repeats, place = [], np.arange(n)
        for width in range(1, min(n // 2, math.ceil(limit)) + 1):
            differ = np.append(codes[:-width] != codes[width:], np.ones(width, bool))
            first = np.minimum.accumulate(np.where(differ, place, n)[::-1])[::-1]
            until = np.minimum(first + width, n)
            until[until - place < 2 * width] = 0
            # a unit that is a repeat itself is cheaper as one of its own, shorter unit
            for other in repeats:
                if width % other.step == 0:
                    shorter = np.array(other.ends)
                    until[shorter >= place + 2 * width] = 0
            if until.any():
                repeats.append(Runs(width, 3 if width == 1 else 2, until.tolist()))
        return Runs(1, 3, ends), repeats

    def _below(self, value: str, limit: float) -> float:
        """The least cost if it is below ``limit``, else a number that isn't."""
        n = len(value)
        # (the one letter that lower() makes two of)
        plain = value.replace("İ", "i").lower()
        leet, pool = plain.translate(LEET), [self._pool(c) for c in value]
        walks, repeats = self._runs(plain, value, limit)
        best = [0.0] + [math.inf] * n
        force, far = math.inf, 0
        for i in range(n + 1):
            #: ``force``: the cheapest way to i that ends in a brute-force span still open
            here = min(best[i], force) if i else 0.0
            for runs in (walks, *repeats):
                if runs.open:
                    here = min(here, runs.cheapest(i))
            best[i] = here
            if i == n:
                break
            start = here + (self.BOUNDARY if i else 0.0)
            if start < limit:
                for end, cost in self._words(value, plain, leet, i):
                    best[end] = min(best[end], start + cost)
                    far = max(far, end)
                if value[i].isdigit() and (m := DATE.match(value, i)):
                    best[m.end()] = min(best[m.end()], start + (4.6 if m.end() - i > 4 else 2.1))
                    far = max(far, m.end())
                if start + self.WALK < limit and walks.begin(i, start + self.WALK):
                    far = max(far, walks.ends[i])
                for runs in repeats:
                    if runs.ends[i]:
                        cost = start + sum(pool[i : i + runs.step])
                        if cost < limit and runs.begin(i, cost):
                            far = max(far, runs.ends[i])
            elif force >= limit and far <= i:
                return limit
            force = min(force, start) + pool[i]
        return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base kinds, leftmost and without overlap within a kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def guess_spans(text: str, rate: GuessCost, min_log10: float) -> list[tuple[int, int, int]]:
    out = set()
    for pattern in (CONTEXT, URL_LOGIN) if "://" in text else (CONTEXT,):
        for m in pattern.finditer(text):
            start, value = m.start(m.lastindex), m[m.lastindex]
            if m.lastindex == pattern.groups:
                value = re.sub(r"""["'`,;)\]}>“”„«»]+$""", "", value)
            if len(value) >= 6 and rate.log10(value, min_log10) >= min_log10:
                out.add((start, 3, start + len(value)))
    return sorted(out)


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: Iterable[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each covered stretch replaced by the mark (overlaps once)."""
    out, done = [], 0
    for start, _, end in sorted(spans):
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], mark]
        done = end
    return "".join([*out, text[done:]])


SCHEMA = "n_assign long, n_access long, n_hex long, n_guess long, base string, spans string, redacted string"


def scan(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, min_log10: float = 8.0, words: Iterable[str] = COMMON, vocabularies: tuple[str, ...] = (), redacted: bool = True) -> DataFrame:
    """Each row of ``docs`` with its secrets: counts, base spans, all spans and (if asked for) the redacted text.

    ``keep`` names the columns to carry over (all by default; a carried column named like a new one gives way).
    The dictionary is ``words``, then those of the ``vocabularies`` (files on the executors, see ``frequent_words``).
    A null text counts as empty for the spans, and its redacted text is null.  No shuffle; rows are independent, so
    repeated rows come back as often as they came.
    """
    new = [c.split()[0] for c in SCHEMA.split(", ")]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    words = tuple(words)
    source = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*[f"`{c}`" for c in keep]).schema), SCHEMA])

    def run(batches):
        rate = GuessCost((*words, *frequent_words(*vocabularies)))
        for batch in batches:
            rows = {c: [] for c in new}
            for t in batch.column(batch.num_columns - 1).to_pylist():
                base = base_spans(t or "")
                more = guess_spans(t or "", rate, min_log10)
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                every = sorted([*base, *more])
                for name, value in zip(new, [*counts, len(more), joined(base), joined(every), (redact(t, every) if every else t) if redacted and t is not None else None]):
                    rows[name].append(value)
            arrays = [pa.array(rows[c], pa.int64() if c.startswith("n_") else pa.string()) for c in new]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*keep, *new])

    return source.mapInArrow(run, schema)

