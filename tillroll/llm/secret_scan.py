"""Operator 4: secrets by a randomness test battery, in DataFrame functions.

Base patterns give spans that always stay.  Every other long token of a text
is put to a battery of tests under the encoding that its kinds of characters
suggest (base 10, 16, 32, 36, 62 or 64, the first four in either case): chi-squared of the alphabet's uniformity, runs above and
below the middle, and serial correlation, each as a standard normal deviate.
Their sum of squares is small for random strings.  Tokens of plain letters
give the distribution of its logarithm for natural strings, by class of
length; a token's p-value is the chance that a natural string of its length
looks as random.  Within each class the Benjamini-Hochberg rule, over counts
of p-values in fine bins, bounds the share of false discoveries; a token must
also pass as random itself.

Counts have at most CLASSES x BINS rows; only these come to the driver, and
the limits go back as literals.

Defined results: a NULL text is empty and has no spans.  Repeated rows are
judged alike.  The natural tokens of a length class are added to PRIOR fixed
ones, so a small table or one without natural tokens is judged too.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import cut
from tillroll.llm.spans import apart, find, joined, let, masked

KINDS = ["assign", "access", "hex", "random"]
#: The base patterns, written so that a scan is linear.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]+")
ASSIGNED = r"^(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
#: Tokens that are tested, natural ones, and how alphabets are ordered.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
NATURAL = r"^[A-Za-z][a-z]+$"
ALPHABETS = {10: "0123456789", 16: "0123456789abcdef", 32: "abcdefghijklmnopqrstuvwxyz234567",
             36: "abcdefghijklmnopqrstuvwxyz0123456789",
             62: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             64: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: The symbols whose counts are tested together.
GROUPS = {10: [*ALPHABETS[10]], 16: [*ALPHABETS[16]], 32: ["a-g", "h-m", "n-s", "t-z", "2-7"],
          36: ["a-g", "h-m", "n-s", "t-z", "0-9"], 62: ["A-M", "N-Z", "a-m", "n-z", "0-9"],
          64: ["A-M", "N-Z", "a-m", "n-z", "0-9+/"]}

#: Share of false discoveries, and the level at which a token fails as random.
FALSE_SHARE, RANDOM_LEVEL = 0.01, 0.001
#: Classes of length (powers of two from 16 on) and bins of -log10 p, a
#: twentieth wide.
CLASSES, BINS = 12, 1200
#: Tokens of each length class that count beside the table's own, their mean logarithm
#: in the first class, its step from class to class, and its variance; from words of the
#: test data, longer classes from words run together.
PRIOR, MEAN, STEP, VARIANCE = 30, 3.2, 0.6, 0.06


def _base(s: Column) -> Column:
    """Small letters alone are no sign of an encoding: they are taken as base 64."""
    return (F.when(s.rlike("^[0-9]+$"), 10).when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
            .when(s.rlike("^([A-Z2-7]+|(?=.*[2-7])[a-z2-7]+)$"), 32)
            .when(s.rlike("^([A-Z0-9]+|(?=.*[0-9])[a-z0-9]+)$"), 36)
            .when(s.rlike("^(?=.*[0-9])[A-Za-z0-9]+$"), 62).otherwise(64))


def _by_base(k: Column, of) -> Column:
    out = F.when(k == 10, of(10))
    for base in [*ALPHABETS][1:-1]:
        out = out.when(k == base, of(base))
    return out.otherwise(of(64))


def _chi_squared(s: Column, k: Column) -> Column:
    """Deviate of the chi-squared statistic (Wilson and Hilferty): over single
    symbols for bases 10 and 16, over groups of symbols for larger alphabets."""
    n = F.length(s).cast("double")
    left = lambda chars: n - F.length(F.regexp_replace(s, f"[{chars}]", ""))

    def stat(base: int) -> Column:
        total = F.lit(0.0)
        for chars in GROUPS[base]:
            share = len(re.findall(f"[{chars}]", ALPHABETS[base])) / base
            total = total + F.pow(left(chars) - n * share, 2) / (n * share)
        return _deviate(total, len(GROUPS[base]) - 1)

    return _by_base(k, stat)


def _deviate(x: Column, df: int) -> Column:
    c = 2 / (9 * df)
    return (F.pow(x / df, 1 / 3) - (1 - c)) / math.sqrt(c)


def _sequence(s: Column, k: Column) -> Column:
    """Squares of the deviates of the runs and serial-correlation tests."""
    def code(alphabet: str):
        return F.transform(F.split(s, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))

    codes = _by_base(k, lambda base: code(ALPHABETS[base]))
    middle, spread = (k - 1) / 2, (k * k - 1) / 12

    def stats(x: Column) -> Column:
        steps = F.size(x) - 1
        sums = F.aggregate(
            F.slice(x, 2, steps),
            F.struct(F.element_at(x, 1).alias("last"), F.lit(0.0).alias("serial"), F.lit(0.0).alias("turns")),
            lambda acc, c: F.struct(
                c.alias("last"), (acc["serial"] + (acc["last"] - middle) * (c - middle)).alias("serial"),
                (acc["turns"] + F.when((acc["last"] > middle) != (c > middle), 1.0).otherwise(0.0)).alias("turns")))
        return let(sums, lambda a: F.pow((a["turns"] - steps / 2) / (F.sqrt(steps.cast("double")) / 2), 2)
                   + F.pow(a["serial"] / (spread * F.sqrt(steps.cast("double"))), 2))

    return let(codes, stats)


def battery(token: Column) -> Column:
    """Sum of squares of the three deviates; near 3 for a random string.  A
    uniformity better than chance counts as no deviation."""
    def tested(x: Column) -> Column:
        s = F.when(x["k"] <= 36, F.lower(x["s"])).otherwise(x["s"])
        return F.pow(F.greatest(_chi_squared(s, x["k"]), F.lit(0.0)), 2) + _sequence(s, x["k"])

    plain = F.translate(token, "-_", "+/")
    return let(F.struct(plain.alias("s"), _base(plain).alias("k")), tested)


def length_class(token: Column) -> Column:
    size = F.floor(F.log2(F.length(token).cast("double"))) - 4
    return F.greatest(F.lit(0), F.least(size, F.lit(CLASSES - 1))).cast("int")


def _tail(z: Column) -> Column:
    """Chance of a normal deviate below ``z`` (Abramowitz and Stegun 26.2.17),
    relative to the density so that far tails keep their size."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z < 0, upper).otherwise(1 - upper)


def passes_as_random(score: Column) -> Column:
    """Chi-squared with three degrees of freedom exceeds ``score`` with more
    than RANDOM_LEVEL: score below the upper point, about 16.27."""
    return score < F.lit(16.266236)


def scanned(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns of ``keep`` in the struct ``row``, base spans, and tested tokens
    beside them."""
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = F.col("t")
    assign = F.filter(find(t, ASSIGN, F.contains(t, F.lit("=")) | F.contains(t, F.lit(":"))),
                      lambda c: F.length(F.regexp_extract(c["s"], ASSIGNED, 1)) >= 6)
    rows = rows.select("row", assign.alias("assign"),
                       find(t, ACCESS, F.contains(t, F.lit("AKIA"))).alias("access"),
                       find(t, HEX).alias("hex"), find(t, TOKEN).alias("tokens"))
    mark = lambda name, kind: F.transform(name, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.lit(kind).alias("kind")))
    rows = rows.select("row", F.concat(mark("assign", 0), mark("access", 1), mark("hex", 2)).alias("base"), "tokens")
    rows = rows.select("row", "base", apart(F.col("tokens"), F.col("base")).alias("tokens"))
    return rows.select("row", "base", F.transform("tokens", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), length_class(c["s"]).alias("size"),
        c["s"].rlike(NATURAL).alias("natural"), battery(c["s"]).alias("score"))).alias("tokens"))


def discovery_limits(counts: dict[int, dict[int, int]], share: float = FALSE_SHARE) -> dict[int, int]:
    """Benjamini-Hochberg per length class over counts by bin of -log10 p: the
    lowest bin whose p-values, all taken at the bin's upper end, still pass."""
    limits = {}
    for size, bins in counts.items():
        total, rank = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            rank += bins[b]
            if 10 ** (-b / 20) <= share * rank / total:
                limits[size] = b
    return limits


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): structs (start, end, kind) per document, ``kind`` being
    a place in KINDS."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _spans(scanned(rows, ["doc_id"])).select("row.doc_id", "spans")


def without_secrets(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs``, all columns, with every span in ``text`` replaced by ``mask``."""
    found = _spans(scanned(docs, docs.columns, text))
    new = masked(F.col("row")[text], F.col("spans"), mask)
    return found.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def _spans(found: DataFrame) -> DataFrame:
    found = cut(found, "secret-tokens")
    each = found.select(F.explode("tokens").alias("c")).select("c.*")
    log = F.log(F.col("score") + 0.1)
    rows = (each.where("natural").groupBy("size")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(log).alias("s"), F.sum(log * log).alias("q")).collect())
    own = {r["size"]: (r["n"], r["s"], r["q"]) for r in rows}
    figures = {size: _with_prior(size, own.get(size, (0, 0.0, 0.0))) for size in range(CLASSES)}

    def z(c: Column) -> Column:
        out = _normal(F.log(c["score"] + 0.1), figures[0])
        for size in range(1, CLASSES):
            out = F.when(c["size"] == size, _normal(F.log(c["score"] + 0.1), figures[size])).otherwise(out)
        return out

    def bin_of(c: Column) -> Column:
        p = F.greatest(_tail(z(c)), F.lit(1e-60))
        return F.least(F.floor(-20 * F.log10(p)), F.lit(BINS - 1)).cast("int")

    binned = found.withColumn("tokens", F.transform("tokens", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["size"].alias("size"),
        c["score"].alias("score"), bin_of(c).alias("bin"))))
    counts: dict[int, dict[int, int]] = {}
    for r in (binned.select(F.explode("tokens").alias("c")).groupBy("c.size", "c.bin").count().collect()):
        counts.setdefault(r["size"], {})[r["bin"]] = r["count"]
    limits = discovery_limits(counts)

    def discovered(c: Column) -> Column:
        hit = F.lit(False)
        for size, low in limits.items():
            hit = hit | ((c["size"] == size) & (c["bin"] >= low))
        return hit & passes_as_random(c["score"])

    extra = F.transform(F.filter("tokens", discovered), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.lit(3).alias("kind")))
    return binned.select("row", F.concat("base", extra).alias("spans"))


def _with_prior(size: int, own: tuple[int, float, float]) -> tuple[float, float, float]:
    mean = MEAN + STEP * size
    return own[0] + PRIOR, own[1] + PRIOR * mean, own[2] + PRIOR * (VARIANCE + mean * mean)


def _normal(x: Column, figures: tuple[int, float, float]) -> Column:
    n, s, q = figures
    mean = s / n
    return (x - mean) / math.sqrt(max(q / n - mean * mean, 1e-6))


def digest(spans: DataFrame) -> DataFrame:
    """Counts of base spans, their SHA-256 and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return spans.select("doc_id", *counts, F.sha2(joined(base, KINDS), 256).alias("base_sha256"),
                        joined(F.col("spans"), KINDS).alias("spans"))
