"""Secret scan: known forms, and a randomness test battery for the rest.

Known forms (assignments, access keys, hex keys) are found by pattern.  All other
runs of key characters of ``MIN_LENGTH`` or more are candidates; ``=`` ends a run, as
padding, so a value after ``name=`` is a run of its own.  Of a run that touches a known
form, fits no alphabet or does not look uniform, the parts between signs (``_-``,
``+/`` or all four) that are long enough are candidates too.  Their encoding is
inferred from the characters they use, and three tests ask whether a candidate looks
like uniform draws from that encoding's alphabet:

* chi-squared over the alphabet's symbols, in as many equal cells as the length allows;
* runs above and below the alphabet's middle (Wald-Wolfowitz);
* serial correlation of neighbouring symbols.

A candidate that fails any at ``UNIFORM_LEVEL`` is structured and no secret.  One that
passes gets a p-value against ordinary tokens of its encoding and length: the battery's
fourth statistic is the likelihood ratio of uniform draws from the inferred alphabet
against a chain of ordinary symbols, whose kind (lower, upper, digit, sign) changes with
``SWITCH_RATE`` and whose letters follow each other as in the corpus's own words (a
capital may begin a word anywhere).  As the ratio's mean over such tokens is 1, its
inverse is a p-value (Markov).  The letter pairs are counted over all distinct
runs of key characters of up to ``WORD_LENGTH``, candidates too; a share of each chain step is kept for
letters regardless of the one before, and for all letters alike.  False discoveries are
controlled per encoding and length class (Benjamini-Hochberg at ``FDR``) over all
candidates of the corpus: counts per class and p-value bin are summed by Spark, which
gives each class its bound.

Offsets are code points, ends exclusive.  Defined cases: a null text is empty;
a candidate that touches a known form is not listed again; parts of one run may overlap
and are then all listed; copies are scanned alike.
Extra columns pass through; n_assign, n_access, n_hex and spans are replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.components import written
from tierlake.llm.words import text_slices

# fixed values: the known forms, in the order in which kinds are listed
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 8, "access": 16, "hex": 32}

MIN_LENGTH = 20
# = only at the end, as padding: the value after name= is a run of its own
CANDIDATE = re.compile(r"(?=[A-Za-z0-9+/_=-]{%d})[A-Za-z0-9+/_-]+={0,6}" % MIN_LENGTH)
SPLITS = [re.compile(r"[A-Za-z0-9%s]+={0,6}" % signs) for signs in ("+/", "_-", "")]
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_SETS = [(name, frozenset(a), {c: k for k, c in enumerate(a)}) for name, a in ALPHABETS.items()]
UNIFORM_LEVEL = 0.001
SWITCH_RATE = 0.15
FDR = 1e-4
BINS = 160                     # p-value bins, one per power of two
PAIR, SINGLE, ANY = 0.75, 0.2, 0.05    # shares of a step: after the letter before, any word's letter, all alike
PRIOR = 50.0                   # letters, spread alike, that every count starts from
WORD_LENGTH = 128              # longer runs are data, not words
HELD_WORDS = 1 << 17           # distinct runs a task holds at once


def _upper_gamma(a: float, x: float) -> float:
    """Q(a, x), the upper regularised incomplete gamma function, a a multiple of 1/2."""
    if x <= 0:
        return 1.0
    if a == int(a):
        term = total = math.exp(-x)
        k = 1.0
    else:
        total = math.erfc(math.sqrt(x))
        term = math.exp(-x) / math.sqrt(math.pi * x)
        k = 0.5
    while k < a - 0.25:
        term *= x / k
        total += term
        k += 1
    return min(1.0, total)


def encoding_of(token: str) -> tuple[str, list[int], int] | None:
    """(name, symbol numbers, alphabet size) of the smallest alphabet that fits."""
    body = token.rstrip("=")
    used = set(body)
    for name, members, code in _SETS:
        if used <= members:
            return name, [code[c] for c in body], len(code)
    return None


def uniform_p(symbols: list[int], size: int) -> float:
    """Least p-value of the battery, times its number of tests."""
    n = len(symbols)
    if n < 8:
        return 0.0
    cells = max(2, min(size, n // 5))
    counts = [0] * cells
    width = [0] * cells
    for s in range(size):
        width[s * cells // size] += 1
    for s in symbols:
        counts[s * cells // size] += 1
    chi = sum((c - n * w / size) ** 2 / (n * w / size) for c, w in zip(counts, width))
    p_chi = _upper_gamma((cells - 1) / 2, chi / 2)
    high = [2 * s >= size for s in symbols]
    up = sum(high)
    down = n - up
    if not up or not down:
        return 0.0
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 1 + 2 * up * down / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = math.erfc(max(0.0, abs(runs - mean) - 0.5) / math.sqrt(2 * var)) if var > 0 else 0.0
    middle = (size - 1) / 2
    square = sum((s - middle) ** 2 for s in symbols)
    product = sum((a - middle) * (b - middle) for a, b in zip(symbols, symbols[1:]))
    p_serial = math.erfc(abs(product / square) * math.sqrt(n / 2)) if square else 0.0
    return min(1.0, 3 * min(p_chi, p_runs, p_serial))


@lru_cache(maxsize=1 << 16)
def _tail(n: int, k: int, q: float) -> float:
    """P(Binomial(n, q) >= k)."""
    if k <= 0:
        return 1.0
    total, log = 0.0, math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) \
        + k * math.log(q) + (n - k) * math.log1p(-q)
    for i in range(k, n + 1):
        total += math.exp(log)
        if i < n:
            log += math.log(n - i) - math.log(i + 1) + math.log(q) - math.log1p(-q)
    return min(1.0, total)


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


PAIRS = 27 * 27                # 0 for all but letters, then a to z of either case
_LETTERS = np.zeros(256, dtype=np.int64)
_LETTERS[65:91] = _LETTERS[97:123] = np.arange(1, 27)
_RUN = re.compile(rb"[a-z0-9+/_=-]+")


def letter_pairs(words: list[bytes]) -> np.ndarray:
    """Counts of neighbouring symbols, a word's start and end being no letters."""
    code = _LETTERS[np.frombuffer(b"\n" + b"\n".join(words) + b"\n", dtype=np.uint8)]
    return np.bincount(code[:-1] * 27 + code[1:], minlength=PAIRS)


class Ordinary:
    """Bits of ordinary letters: ``bits[a][b]`` of letter b after a (0: no letter)."""

    def __init__(self, pairs: tuple[int, ...] = (0,) * PAIRS):
        n = np.array(pairs, dtype=np.float64).reshape(27, 27)[:, 1:]
        single = (n.sum(axis=0) + PRIOR / 26) / (n.sum() + PRIOR)
        pair = (n + PRIOR * single) / (n.sum(axis=1, keepdims=True) + PRIOR)
        self.bits = (-np.log2(PAIR * pair + SINGLE * single + ANY / 26)).tolist()

    def p(self, token: str, size: int) -> float:
        """P-value of a token whose inferred alphabet has ``size`` symbols."""
        stay, change = -math.log2(1 - SWITCH_RATE), -math.log2(SWITCH_RATE / 3)
        capital = -math.log2((1 - SWITCH_RATE * 2 / 3) / 2)     # an upper or lower letter after an upper one
        signs = math.log2(max(1, size - 62))
        bits, before, kind = 0.0, 0, -1
        for c in token:
            now = _kind(c)
            if kind < 0:
                bits += 2.0
            elif kind == 1 and now < 2:
                bits += capital
            else:
                bits += stay if now == kind else change
            if now < 2:
                letter = ord(c.lower()) - 96
                bits += self.bits[0 if (kind, now) == (0, 1) else before][letter - 1]
            else:
                letter = 0
                bits += math.log2(10) if now == 2 else signs
            before, kind = letter, now
        return 2.0 ** max(-1000.0, min(0.0, len(token) * math.log2(size) - bits))


def ordinary_pairs(documents: DataFrame, text: str = "text") -> tuple[int, ...]:
    """``letter_pairs`` of the distinct runs of all texts, summed by Spark.  Each
    run counts once, so a few words that fill the corpus do not make all others odd."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for _, texts in text_slices(batch, text):
                for t in texts:
                    seen.update(w for w in set(_RUN.findall(t.lower() if t else b"")) if len(w) <= WORD_LENGTH)
                if len(seen) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.binary())], names=["word"])
                    seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.binary())], names=["word"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS, dtype=np.int64)
        for batch in batches:
            for _, found in text_slices(batch, "word"):
                total += letter_pairs(found)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                                         names=["pair", "n"])

    out = [0] * PAIRS
    counted = documents.select(text).mapInArrow(words, "word binary").distinct().mapInArrow(count, "pair int, n long")
    for r in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return tuple(out)


def known_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= LEAST["assign"]]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def token_class(encoding: str, n: int) -> int:
    """One number per encoding and doubling of the length."""
    return 64 * list(ALPHABETS).index(encoding) + n.bit_length()


def p_bin(p: float) -> int:
    return min(BINS, int(-math.log2(p))) if p > 0 else BINS


def candidates(text: str, known: list[tuple[str, int, int]],
               ordinary: Ordinary | None = None) -> list[tuple[int, int, int, int, bool]]:
    """(start, end, class, bin of the p-value, looks uniform) of all other tokens."""
    ordinary = ordinary or Ordinary()
    out = []
    starts = [x for _, x, _ in known]
    ends = list(accumulate((y for _, _, y in known), max))     # of all known forms so far

    def test(a: int, b: int) -> bool:
        """Lists the run, unless it touches a known form; whether it looks uniform."""
        before = bisect_left(starts, b)                        # known forms that start before b
        if before and a < ends[before - 1]:
            return False
        found = encoding_of(text[a:b])
        if not found:
            return False
        name, symbols, size = found
        uniform = uniform_p(symbols, size) >= UNIFORM_LEVEL
        p = ordinary.p(text[a:b].rstrip("="), size) if uniform else 1.0
        out.append((a, b, token_class(name, len(symbols)), p_bin(p), uniform))
        return uniform

    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if b - a < MIN_LENGTH or test(a, b):
            continue
        parts = {x.span() for split in SPLITS for x in split.finditer(text, a, b)}
        for x, y in sorted(parts - {(a, b)}):
            if y - x >= MIN_LENGTH:
                test(x, y)
    return out


BASE, MORE = "__known", "__candidates"
_SPAN = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
_CANDIDATE = (T.StructType().add("start", "long").add("end", "long").add("class", "integer")
              .add("bin", "integer").add("uniform", "boolean"))


def scan(documents: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``documents`` plus the known spans and the candidates with their test results.
    The letter pairs are counted first, in a pass of its own."""
    from pyspark.sql.pandas.types import to_arrow_type

    kept = [f.name for f in documents.schema if keep_text or f.name != text]
    schema = documents.select(*kept).schema.add(BASE, T.ArrayType(_SPAN)).add(MORE, T.ArrayType(_CANDIDATE))
    pairs = ordinary_pairs(documents, text)
    base_type, more_type = to_arrow_type(T.ArrayType(_SPAN)), to_arrow_type(T.ArrayType(_CANDIDATE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary = Ordinary(pairs)
        for batch in batches:
            for rows, texts in text_slices(batch, text):
                base, more = [], []
                for t in texts:
                    t = t.decode() if t else ""
                    known = known_spans(t)
                    base.append([dict(zip(_SPAN.names, s)) for s in known])
                    more.append([dict(zip(_CANDIDATE.names, c)) for c in candidates(t, known, ordinary)])
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(base, base_type), pa.array(more, more_type)],
                    names=[*kept, BASE, MORE])

    return documents.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def discovery_bounds(scanned: DataFrame) -> dict[int, int]:
    """Least p-value bin per class at which a candidate is a discovery: the
    step-up rule on binned p-values of all candidates.  At most some ten thousand
    counts reach the driver, however large the corpus is."""
    counts: dict[int, dict[int, int]] = {}
    for r in (scanned.select(F.explode(MORE).alias("c")).groupBy("c.class", "c.bin").count()).collect():
        counts.setdefault(r["class"], {})[r["bin"]] = r["count"]
    out = {}
    for cls, bins in counts.items():
        total, found = sum(bins.values()), 0
        for b in range(BINS, 0, -1):
            found += bins.get(b, 0)
            if found and total * 2.0 ** -b <= FDR * found:
                out[cls] = b
    return out


def with_spans(scanned: DataFrame, bounds: dict[int, int]) -> DataFrame:
    """Adds ``spans``: array of struct<start, rank, kind, end>, sorted by start, then kind."""
    rank = F.create_map(*[x for k, name in enumerate(KINDS) for x in (F.lit(name), F.lit(k))])
    no_bound = F.lit(BINS + 1)
    bound = F.create_map(*[F.lit(x) for cv in bounds.items() for x in cv]) if bounds else None

    def span(kind, start, end):
        return F.struct(start.alias("start"), rank[kind].alias("rank"), kind.alias("kind"), end.alias("end"))

    def discovered(c):
        at = F.coalesce(bound[c["class"]], no_bound) if bound is not None else no_bound
        return c["uniform"] & (c["bin"] >= at)

    base = F.transform(BASE, lambda s: span(s["kind"], s["start"], s["end"]))
    more = F.transform(F.filter(MORE, discovered), lambda c: span(F.lit(KINDS[3]), c["start"], c["end"]))
    return scanned.withColumn("spans", F.array_sort(F.concat(base, more)))


def listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def find_secrets(spark: SparkSession, documents: DataFrame, text: str = "text",
                 keep_text: bool = False) -> DataFrame:
    """``documents`` plus ``spans``.  Texts are read twice (letter pairs, scan); the results are written to the
    shared folder and read for the corpus-wide bounds and for the result."""
    scanned = written(spark, scan(documents, text, keep_text), "secret_scan")
    return with_spans(scanned, discovery_bounds(scanned)).drop(BASE, MORE)


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(doc_id, *[count(k) for k in KINDS[:3]],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[dict], mask: str) -> str:
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += text[at:s["start"]], mask
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def redact(found: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """Every span's code points replaced by the mask (overlapping spans by one); drops ``spans``."""
    kept = [f.name for f in found.schema if f.name != "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, text):
                clean = [t if t is None else masked(t.decode(), s, mask) if s else t.decode()
                         for t, s in zip(texts, rows.column("spans").to_pylist())]
                new = pa.array(clean, rows.schema.field(text).type)
                yield pa.RecordBatch.from_arrays([new if c == text else rows.column(c) for c in kept], names=kept)

    return found.mapInArrow(run, found.select(*kept).schema)
