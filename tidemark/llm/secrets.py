"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

Patterns find assigned passwords and tokens, access keys and long hex. Besides,
every maximal run of key characters (``LEAST`` or more) is a candidate, unless it
touches one of their spans. Its encoding is the smallest alphabet that holds it. The
battery tests whether it looks drawn evenly from that alphabet: chi-squared on
the characters, a runs test about the middle of the alphabet, and the serial
correlation of neighbours.

The evidence for a candidate is an e-value under the hypothesis that it is
ordinary text: the likelihood ratio of even draws to a model of written words, as
a mixture over the alphabets (each has an equal share, since the alphabet is
chosen after the characters are seen), times the battery's combined p-value. Under
the text model the ratio's mean is at most 1, and the p-value only lowers it: what
does not look random would need that much more evidence. Length sets what the
evidence can reach, so candidates are judged against others of their length: in
each length band the e-value form of Benjamini and Hochberg's procedure keeps the
share of false finds at ``ALPHA``. Its thresholds come from counts over all
documents, a histogram of bounded size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import keep, ready
from tidemark.llm.textblocks import slices

#: Fixed by the contract of the base scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
BANDS = (20, 28, 40, 64)
ALPHA = 0.01
#: A combined p-value below which the battery is said to reject, for reports; the procedure takes the p-value itself.
REJECT = 0.001
BINS_PER_NAT = 4

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_CLASS = np.zeros(256, bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-":
    _CLASS[_c] = True
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings from the smallest alphabet to the largest.
ALPHABETS = (
    ("decimal", _DIGITS),
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("lower", _LOWER),
    ("upper", _UPPER),
    ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _LOWER),
    ("BASE36", _DIGITS + _UPPER),
    ("letters", _UPPER + _LOWER),
    ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("any", _UPPER + _LOWER + _DIGITS + "+/-_="),
)
_SETS = tuple((name, frozenset(chars), {c: k for k, c in enumerate(chars)}) for name, chars in ALPHABETS)

#: Letters of written European text per thousand, a to z, rounded.
LETTERS = (80, 15, 30, 40, 130, 18, 18, 30, 75, 3, 6, 40, 27, 72, 70, 25, 4, 65, 68, 75, 35, 12, 12, 3, 12, 5)
#: Text model: chance of lower, upper, digit, mark after each of those (and at the start).
STEPS = {
    "": (0.70, 0.20, 0.08, 0.02),
    "lower": (0.965, 0.010, 0.010, 0.015),
    "upper": (0.60, 0.37, 0.02, 0.01),
    "digit": (0.05, 0.03, 0.88, 0.04),
    "mark": (0.45, 0.10, 0.25, 0.20),
}
_PLACE = {**{c: (0, LETTERS[k] / sum(LETTERS)) for k, c in enumerate(_LOWER)}, **{c: (1, LETTERS[k] / sum(LETTERS)) for k, c in enumerate(_UPPER)}, **{c: (2, 0.1) for c in _DIGITS}, **{c: (3, 0.2) for c in "+/-_="}}
_ROWS = tuple(STEPS[k] for k in ("lower", "upper", "digit", "mark"))


def encoding(token: str) -> tuple[str, dict[str, int]]:
    """The first alphabet that holds the token, and the places of its characters."""
    chars = frozenset(token)
    return next((name, at) for name, alphabet, at in _SETS if chars <= alphabet)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[float, float, float]:
    """p-values, under even draws from the inferred alphabet, of the chi-squared, runs and serial-correlation tests."""
    _, at = encoding(token)
    x = np.array([at[c] for c in token])
    n, k = len(x), len(at)
    counts = np.bincount(x, minlength=k)
    chi = float((counts * counts).sum() * k / n - n)
    # the statistic's exact mean and variance, and Wilson and Hilferty's cube root, hold for few draws a character
    var = 2 * (k - 1) * (n - 1) / n
    shape = 2 * (k - 1) ** 2 / var
    chi_z = ((max(chi, 0) / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * shape))) / math.sqrt(2 / (9 * shape))
    above = x >= k / 2
    up, down = int(above.sum()), int(n - above.sum())
    runs = 1 + int((above[1:] != above[:-1]).sum())
    mean = 1 + 2 * up * down / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 2.0**-n
    centred = x - x.mean()
    total = float((centred * centred).sum())
    serial_p = _two_sided(((float((centred[1:] * centred[:-1]).sum()) / total) + 1 / n) * math.sqrt(n)) if total else 0.0
    return _two_sided(chi_z), runs_p, serial_p


def combined(token: str) -> float:
    """One p-value of the battery's tests, by Bonferroni."""
    tests = battery(token)
    return min(1.0, len(tests) * min(tests))


def evidence(token: str) -> float:
    """Log of the likelihood of even draws, in a mixture over the alphabets, over that of the text model (a lower bound: the best alphabet's part)."""
    _, at = encoding(token)
    text, row = 0.0, STEPS[""]
    for c in token:
        kind, share = _PLACE[c]
        text += math.log(row[kind] * share)
        row = _ROWS[kind]
    return -len(token) * math.log(len(at)) - text - math.log(len(ALPHABETS))


def band_of(length: int) -> int:
    return sum(length >= b for b in BANDS) - 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed patterns."""
    out = []
    lower = text.lower()
    if any(k in lower for k in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, float]]:
    """(start, end, log of the e-value) of runs apart from the spans taken, which are in order of their starts."""
    out = []
    spans = iter(taken)
    ahead, reach = next(spans, None), -1
    for m in _RUN.finditer(text):
        # runs are in order too: spans that begin before a run's end are passed once
        while ahead is not None and ahead[0] < m.end():
            reach, ahead = max(reach, ahead[2]), next(spans, None)
        token = m.group().rstrip("=")
        if len(token) < LEAST or reach > m.start():
            continue
        e = evidence(token)
        if e > 0:
            p = combined(token)
            e = e + math.log(p) if p else -math.inf
        out.append((m.start(), m.start() + len(token), e))
    return out


def _may_hold(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a run of LEAST key characters, one of the patterns' words, or neither (False)."""
    inside = np.concatenate([[False], _CLASS[raw], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= LEAST
    hold = np.zeros(len(offsets) - 1, bool)
    hold[np.searchsorted(offsets, begin[long], "right") - 1] = True
    # a long run may lie in two texts; both are looked at
    last = np.searchsorted(offsets, end[long] - 1, "right") - 1
    for a, b in zip((np.searchsorted(offsets, begin[long], "right") - 1).tolist(), last.tolist()):
        hold[a : b + 1] = True
    for d in np.flatnonzero(~hold).tolist():
        low = raw[offsets[d] : offsets[d + 1]].tobytes().lower()
        hold[d] = any(k in low for k in (b"passw", b"secret", b"token", b"api"))
    return hold


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are kind:start:end in code points by start, then kind; the digest is
    over the base kinds' spans alone. Defined cases: a null text counts as empty
    and has no spans (the digest of the empty string); texts of any length are
    read whole; repeated rows are judged alike, each counting as a test; null ids
    are carried; an empty table gives no rows; other columns are ignored.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]))
        found = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("band", pa.int32()), ("bin", pa.int32())]))
        for batch in batches:
            for part, raw, offsets in slices(batch, "text"):
                base, more = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                for d in np.flatnonzero(_may_hold(raw, offsets)).tolist():
                    text = raw[offsets[d] : offsets[d + 1]].tobytes().decode(errors="replace")
                    spans = base_spans(text)
                    base[d] = [{"start": a, "kind": k, "stop": b} for a, k, b in spans]
                    more[d] = [{"start": a, "stop": b, "band": band_of(b - a), "bin": math.floor(min(e, 500.0) * BINS_PER_NAT) if e > 0 else 0} for a, b, e in candidates(text, spans)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(base, span), pa.array(more, found)], names=["doc_id", "base", "more"])

    rows = keep(texts.mapInArrow(scan, "doc_id long, base array<struct<start:long, kind:int, stop:long>>, more array<struct<start:long, stop:long, band:int, bin:int>>"))
    # at most len(BANDS) x 500 x BINS_PER_NAT counts
    counts = rows.select(F.explode("more").alias("m")).groupBy("m.band", "m.bin").count().collect()
    least = thresholds({(r["band"], r["bin"]): r["count"] for r in counts})
    bar = F.array(*(F.lit(least[b]) for b in range(len(BANDS))))
    random = F.transform(F.filter("more", lambda m: m["bin"] >= F.element_at(bar, m["band"] + 1)), lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), m["stop"].alias("stop")))
    rows = rows.withColumn("extra", random)
    number = [F.size(F.expr(f"filter(base, s -> s.kind = {k})")).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return rows.select("doc_id", *number, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.array_sort(F.concat("base", "extra"))).alias("spans"), F.size("extra").cast("long").alias("n_random"))


def thresholds(counts: dict[tuple[int, int], int], alpha: float = ALPHA) -> list[int]:
    """Per band the least bin that is a discovery (e-BH on the lower edges of the bins)."""
    out = []
    for band in range(len(BANDS)):
        own = sorted(((b, n) for (x, b), n in counts.items() if x == band), reverse=True)
        tests, above, least = sum(n for _, n in own), 0, 1 << 30
        for b, n in own:
            above += n
            if b > 0 and b / BINS_PER_NAT >= math.log(tests / (alpha * above)):
                least = b
        out.append(least)
    return out
