"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base spans come from three fixed patterns.  The method adds runs of 20 or
more characters of an encoding alphabet that look random.  For each run the
narrowest encoding that holds all its characters is inferred (digits, hex,
base32, one-case letters and digits, base64, base64url).  The main test is a
likelihood ratio: the chance of the run as evenly drawn characters of an
encoding, against its chance as ordinary text.  What ordinary text is comes
from the runs that are too short to be candidates, so that no share of secrets
among the candidates weakens the test: a trigram model of their characters,
which falls back to pairs, then to kinds of characters and the frequencies of
letters.  It is mixed with one that has only the latter, as names, paths and other
languages are ordinary too, and with runs that count up or repeat themselves.  If text is as the model says, the ratio is at least ``t`` with a chance of at
most ``1 / t``, whatever the length, so its reciprocal is a p-value.

Besides, three statistics are taken in its alphabet: chi-squared against uniform use, the number of
runs above and below the alphabet's middle, and the lag-one serial
correlation.  What ordinary text does in these tests is learnt from all
candidates: by encoding and length band, the mean and the spread of each
statistic over runs that are plain words (letters only) give a normal null;
the excess of chi-squared grows with a run's length and its spread with the
root, so a null carries over to other lengths.  Their p-value is that of ordinary text coming as near to
randomness as the run does, the three combined by Fisher's method.  They tell
little below 64 characters, so a run's p-value is the lesser of the two after
division by ``SHARES`` (Bonferroni, with weights); and the Benjamini-Hochberg procedure
over all candidates of the corpus, by length band, sets the level at
false-discovery rate ``FDR``.

Only sums of bounded size reach the driver: counts of trigrams of 66
characters, moments by stratum and counts by stratum and p-value bucket.  Defined results: a null text is empty and has no
spans; equal rows are scanned one by one; spans are code points with the end
exclusive; a null ``doc_id`` stays null; other columns are ignored, and
``redacted`` keeps them.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vaani.llm.shared import ready, stored
from vaani.llm.words import slices

# The base patterns and their least lengths (of group 2 for assign).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")
RANDOM = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")

#: A cheap superset of each pattern, over whole columns.
_MAYBE = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
    "random": r"[A-Za-z0-9+/_-]{20}",
}

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("digits", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"),
    ("lower", _DIGITS + _LOWER), ("upper", _DIGITS + _UPPER), ("alnum", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"), ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_="),
)
_SETS = [frozenset(a) for _, a in ENCODINGS]
_CODES = [{c: i for i, c in enumerate(a)} for _, a in ENCODINGS]
FDR = 0.01
#: Length bands: edges of the strata.
BANDS = (20, 24, 32, 48, 64, 128)
#: p-values are counted in buckets of this many decibels.
DECIBEL, MOST_BUCKET = 0.5, 800
#: Fewer plain runs than this in a stratum: the spread of text in general stands in.
LEAST_NULL = 30
#: Mean and spread of plain runs (excess of chi-squared over its degrees of
#: freedom, for each of them and each character; runs and correlation in
#: standard errors) and their mean length, where the corpus has too few.
PRIOR = ((0.06, 0.026), (0.65, 0.45), (0.6, 0.42), 21.0)

#: Characters of the text model; 0 stands for all others.
SYMBOLS = _LOWER + _UPPER + _DIGITS + "+/-_"
_SYMBOL = {c: i for i, c in enumerate(SYMBOLS, 1)}
_OF_BYTE = np.zeros(256, np.uint8)
_OF_BYTE[[ord(c) for c in SYMBOLS]] = range(1, len(SYMBOLS) + 1)
_WIDTH = len(SYMBOLS) + 1
#: Kinds of characters (lower, upper, digit, sign), and how they follow each
#: other where nothing is known: after a start, then after each kind.
_KINDS = np.array([0] * 26 + [1] * 26 + [2] * 10 + [3] * 4)
KIND_AFTER = np.array([(0.7, 0.2, 0.08, 0.02), (0.9, 0.03, 0.04, 0.03), (0.45, 0.45, 0.05, 0.05), (0.05, 0.05, 0.88, 0.02), (0.5, 0.2, 0.2, 0.1)])
#: Letters in a hundred of English, German, French and Spanish text, about.
FREQUENCY = dict(e=14.5, a=8, n=8, i=7.5, t=7, s=7, r=6.8, o=6, u=4.5, d=4.5, l=4.3, h=3.5, c=3.2, m=2.8, p=2.2, g=2.2, f=1.6, b=1.6,
                 v=1.3, w=1.2, k=1.1, y=1, z=0.8, q=0.5, j=0.4, x=0.4)
_WITHIN = np.array([FREQUENCY.get(c.lower(), 1) for c in SYMBOLS])
_WITHIN = _WITHIN / np.bincount(_KINDS, _WITHIN)[_KINDS]
#: Weight, in characters, of the pairs in the trigram model and of the kinds in the pairs.
BACK_OFF = (16.0, 64.0)
#: In text: shares of characters that count on (or repeat the last), and that
#: follow the last two as they did before; for prose, and for patterned runs.
HABITS = ((0.01, 0.01), (0.3, 0.3))
#: Weights of the likelihood ratio and of the three statistics.
SHARES = (0.9, 0.1)


def band(n: int) -> int:
    return max(i for i, e in enumerate(BANDS) if n >= e)


def statistics(run: str) -> tuple[int, tuple[float, float, float]]:
    """The inferred encoding, and how far from random the run is in each test (larger: less random)."""
    body = run.rstrip("=") or run
    letters = frozenset(body)
    e = next((i for i, s in enumerate(_SETS) if letters <= s), len(_SETS) - 1)
    code, size = _CODES[e], len(ENCODINGS[e][1])
    x = np.array([code[c] for c in body])
    n = len(x)
    counts = np.bincount(x, minlength=size)
    expected = n / size
    chi = float(((counts - expected) ** 2).sum() / expected) / (size - 1)
    high = x >= size / 2
    a, b = int(high.sum()), int((~high).sum())
    changes = 1 + int((high[1:] != high[:-1]).sum())
    if a and b:
        mean = 2 * a * b / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        run_z = abs(changes - mean) / math.sqrt(var) if var > 0 else 3.0
    else:
        run_z = math.sqrt(n)
    dev = x - x.mean()
    ss = float((dev * dev).sum())
    serial = abs(float((dev[1:] * dev[:-1]).sum()) / ss) * math.sqrt(n) if ss else math.sqrt(n)
    return e, ((chi - 1) / n, run_z, serial)


def _log_phi(z: float) -> float:
    """Natural log of the normal distribution function."""
    if z > -30:
        return math.log(max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-300))
    return -z * z / 2 - math.log(-z * math.sqrt(2 * math.pi))


def text_model(counts: dict[int, float]) -> np.ndarray:
    """Natural log of the chance of each character of ``SYMBOLS`` after the two before it, from counts of trigrams."""
    third = np.zeros(_WIDTH ** 3)
    third[list(counts)] = list(counts.values())
    third = third.reshape(_WIDTH, _WIDTH, _WIDTH)[:, :, 1:]
    kinds = np.array([0, *(_KINDS + 1)])
    guess = (KIND_AFTER[:, _KINDS] * _WITHIN)[kinds]
    second = third.sum(0)
    second = (second + BACK_OFF[1] * guess) / (second.sum(1, keepdims=True) + BACK_OFF[1])
    third = (third + BACK_OFF[0] * second) / (third.sum(2, keepdims=True) + BACK_OFF[0])
    return np.log(third).astype(np.float32)


_UNTAUGHT = text_model({})


def ratio_decibels(run: str, model: np.ndarray | None) -> float:
    """10 log10 of how much likelier the run is as evenly drawn characters of an encoding than as text."""
    body = run.rstrip("=") or run
    x = np.array([_SYMBOL.get(c, 0) for c in body])
    if not x.all():
        return 0.0
    n = len(x)
    before = np.concatenate([[0, 0], x])
    texts = [np.exp(m[before[:-2], before[1:-1], x - 1].astype(float)) for m in (_UNTAUGHT, model) if m is not None]
    step = np.diff([ord(c) for c in body])
    counts_on = np.concatenate([[False, False], step[1:] == step[:-1]])[:n]
    known, again = np.zeros(n, bool), np.zeros(n, bool)
    seen: dict[str, str] = {}
    for i in range(2, n):
        pair = body[i - 2:i]
        if pair in seen:
            known[i], again[i] = True, seen[pair] == body[i]
        seen[pair] = body[i]
    later = np.arange(n) >= 2
    as_text = [float(np.log((1 - a * later - b * known) * text + a * counts_on + b * again).sum()) for text in texts for a, b in HABITS]
    letters = frozenset(body)
    as_random = [-n * math.log(len(alphabet)) for (_, alphabet), s in zip(ENCODINGS, _SETS) if letters <= s]
    logs = np.logaddexp.reduce(as_random) - math.log(len(ENCODINGS)) - np.logaddexp.reduce(as_text) + math.log(len(as_text))
    return 10 * float(logs) / math.log(10)


def p_decibels(stats, null, n: int) -> float:
    """-10 log10 of the chance that ordinary text of ``n`` characters looks as random in all three tests."""
    narrow = (math.sqrt(null[3] / n), 1, 1)
    logs = -sum(_log_phi((x - m) / (s * w)) for x, (m, s), w in zip(stats, null, narrow))
    # Fisher: twice the sum of logs is chi-squared with six degrees of freedom
    tail = -logs + math.log(1 + logs + logs * logs / 2)
    return max(0.0, -10 * tail / math.log(10))


def evidence(run: str, known: dict, model: np.ndarray | None) -> float:
    """-10 log10 of the p-value of the run: the better of the likelihood ratio and the three statistics, by their weights."""
    e, x = statistics(run)
    each = ratio_decibels(run, model), p_decibels(x, null_of(known, e, band(len(run))), len(run))
    return max(0.0, *(d + 10 * math.log10(w) for d, w in zip(each, SHARES)))


def base_spans(text: str, maybe: dict[str, bool]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans of one text."""
    out = []
    if maybe["assign"]:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if maybe["access"]:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if maybe["hex"]:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group()) for m in RANDOM.finditer(text)]


def _maybe(col) -> list[dict[str, bool]]:
    col = pc.fill_null(col, "")
    found = {k: pc.match_substring_regex(col, p).to_pylist() for k, p in _MAYBE.items()}
    return [dict(zip(found, row)) for row in zip(*found.values())]


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def _plain(run: str) -> bool:
    return run.isalpha()


def trigrams(texts: list[str | None]) -> np.ndarray:
    """Counts of the trigrams within runs that are too short to be candidates."""
    x = _OF_BYTE[np.frombuffer("\n".join(["", *(t or "" for t in texts), ""]).encode("utf-8", "replace"), np.uint8)].astype(np.int32)
    gaps = np.flatnonzero(x == 0)
    runs = np.diff(gaps) - 1
    use = np.zeros(len(x), bool)
    use[gaps[0]:gaps[-1]] = np.repeat(runs < BANDS[0], runs + 1)
    use &= x > 0
    at = np.flatnonzero(use)                    # the first is after a gap
    one = x[at - 1]
    two = np.where(one > 0, x[at - 2], 0)
    return np.bincount((two * _WIDTH + one) * _WIDTH + x[at], minlength=_WIDTH ** 3)


def taught(docs: DataFrame) -> np.ndarray:
    """The text model of the corpus."""
    def count(batches):
        total = np.zeros(_WIDTH ** 3, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += trigrams(part.column(0).to_pylist())
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["gram", "n"])

    rows = _text(docs).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return text_model({r.gram: r.n for r in rows.collect()})           # at most 67 ** 3 rows


def nulls(docs: DataFrame) -> dict[tuple[int, int], tuple]:
    """By (encoding, band): (mean, spread) of the three statistics over plain words."""
    def measure(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 0):
                for text, maybe in zip(part.column(0).to_pylist(), _maybe(part.column(0))):
                    for _, _, run in candidates(text) if maybe["random"] else ():
                        if _plain(run):
                            e, x = statistics(run)
                            x = np.array(x)
                            key = (e, band(len(run)))
                            sums[key] = sums.get(key, 0) + np.concatenate([[1], x, x * x, [len(run)]])
        rows = [(e, b, *v.tolist()) for (e, b), v in sums.items()]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int32() if i < 2 else pa.float64()) for i in range(10)],
                              ["e", "b", "n", "x0", "x1", "x2", "y0", "y1", "y2", "chars"])

    rows = _text(docs).mapInArrow(measure, "e int, b int, n double, x0 double, x1 double, x2 double, y0 double, y1 double, y2 double, chars double")
    sums = rows.groupBy("e", "b").agg(*(F.sum(c).alias(c) for c in ("n", "x0", "x1", "x2", "y0", "y1", "y2", "chars"))).collect()
    out = {}
    for r in sums:                  # at most one row for each encoding and band
        if r.n >= LEAST_NULL:
            mean = [r[f"x{i}"] / r.n for i in range(3)]
            spread = [math.sqrt(max(r[f"y{i}"] / r.n - m * m, 1e-6)) for i, m in enumerate(mean)]
            # rounded: sums come in any order
            out[r.e, r.b] = (*((round(m, 9), round(x, 9)) for m, x in zip(mean, spread)), r.chars / r.n)
    return out


def null_of(known: dict, e: int, b: int) -> tuple:
    """The stratum's null; without one, that of the nearest band, then of letters and digits, then the prior."""
    for other in (e, 4, 6):
        near = sorted((abs(b - k), k) for enc, k in known if enc == other)
        if near:
            return known[other, near[0][1]]
    return PRIOR


def levels(docs: DataFrame, known: dict, model: np.ndarray | None = None) -> dict[int, float]:
    """By band: the decibels from which a candidate is a discovery at ``FDR``."""
    def count(batches):
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            for part in slices(batch, 0):
                for text, maybe in zip(part.column(0).to_pylist(), _maybe(part.column(0))):
                    for _, _, run in candidates(text) if maybe["random"] else ():
                        key = (band(len(run)), min(MOST_BUCKET, int(evidence(run, known, model) / DECIBEL)))
                        seen[key] = seen.get(key, 0) + 1
        yield pa.record_batch([pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.int32()),
                               pa.array(list(seen.values()), pa.int64())], ["b", "bucket", "n"])

    rows = _text(docs).mapInArrow(count, "b int, bucket int, n long").groupBy("b", "bucket").agg(F.sum("n").alias("n")).collect()
    return benjamini_hochberg({(r.b, r.bucket): r.n for r in rows})


def benjamini_hochberg(counts: dict[tuple[int, int], int], rate: float = FDR) -> dict[int, float]:
    """The least bucket of each band whose expected false discoveries are within ``rate`` of those found."""
    out = {}
    for b in {k[0] for k in counts}:
        mine = {k[1]: n for k, n in counts.items() if k[0] == b}
        total, above, best = sum(mine.values()), 0, math.inf
        for bucket in sorted(mine, reverse=True):
            above += mine[bucket]
            if total * 10 ** (-bucket * DECIBEL / 10) <= rate * above:
                best = bucket * DECIBEL
        out[b] = best
    return out


class Rules:
    """What the corpus says about ordinary runs; small enough for every task."""

    model: np.ndarray | None = None

    def __init__(self, docs: DataFrame):
        self.known = nulls(docs)
        self.model = taught(docs)
        self.level = levels(docs, self.known, self.model)

    def spans(self, text: str, maybe: dict[str, bool]) -> tuple[list, list]:
        """Base spans, and all spans, ordered by start, then kind."""
        base = sorted(base_spans(text, maybe))
        starts = [s for s, _, _ in base]
        reach = list(itertools.accumulate((t for _, _, t in base), max))       # the farthest end of the spans up to each
        more = []
        for start, end, run in candidates(text) if maybe["random"] else ():
            b = band(len(run))
            bucket = min(MOST_BUCKET, int(evidence(run, self.known, self.model) / DECIBEL))
            before = bisect.bisect_right(starts, start)
            inside = before > 0 and reach[before - 1] >= end
            if bucket * DECIBEL >= self.level.get(b, math.inf) and not inside:
                more.append((start, 3, end))
        return base, sorted(base + more)


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts by base kind, base_sha256, n_random, spans."""
    ready(docs.sparkSession)
    rules = Rules(docs)

    def look(batches):
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).to_pylist()
                rows = [rules.spans(t, m) if any(m.values()) else ([], []) for t, m in zip(texts, _maybe(part.column(1)))]
                tally = lambda k, i: pa.array([sum(s[1] == k for s in r[i]) for r in rows], pa.int64())      # noqa: E731
                yield pa.record_batch([
                    part.column(0), tally(0, 0), tally(1, 0), tally(2, 0),
                    pa.array([hashlib.sha256(_written(r[0]).encode()).hexdigest() for r in rows], pa.string()),
                    pa.array([_written(r[1]) for r in rows], pa.string()), tally(3, 1),
                ], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        look, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


MARK = "[secret]"


def redact(text: str, spans) -> str:
    """The text with each stretch that spans cover replaced by ``MARK``."""
    out, at, end = [], 0, -1
    for a, _, b in spans:
        if a > end:
            out += [text[at:a], MARK]
        end = max(end, b)
        at = end
    return "".join(out) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans replaced in ``text`` and ``n_chars`` (where there is one) counted anew."""
    ready(docs.sparkSession)
    rules = Rules(docs)
    at = docs.columns.index("text")
    chars = next((i for i, f in enumerate(docs.schema.fields) if f.name == "n_chars"), None)

    def change(batches):
        for batch in batches:
            for part in slices(batch, at):
                texts = part.column(at).to_pylist()
                new = [redact(t, s) if any(m.values()) and (s := rules.spans(t, m)[1]) else t for t, m in zip(texts, _maybe(part.column(at)))]
                cols = list(part.columns)
                cols[at] = pa.array(new, part.column(at).type)
                if chars is not None:
                    old = cols[chars].to_pylist()
                    cols[chars] = pa.array([n if a is b else len(b) for a, b, n in zip(texts, new, old)], cols[chars].type)
                yield pa.record_batch(cols, names=part.schema.names)

    return docs.mapInArrow(change, docs.schema)
