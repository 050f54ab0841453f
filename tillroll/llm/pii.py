"""Operator 1: personal data by weak supervision, in DataFrame functions.

Base patterns give spans that always stay.  Wider patterns give further
candidates.  Four labelers vote on every candidate, for (1), against (-1) or
not at all (0): the pattern's own checks, a gazetteer, the words around it and
its edges.  Votes are counted over the corpus by pattern of votes;
expectation-maximisation estimates each labeler's reliabilities and each
kind's prior from these counts, and a logistic classifier over votes, kind and
length is trained on the resulting probabilities.  Candidates it accepts are
added to the base spans.

Counts have at most kinds x 3**4 x LENGTHS rows; only these come to the driver,
and the trained weights go back as literals.

Defined results: a NULL text is empty and has no spans.  Repeated rows are
judged alike.  With no candidates at all nothing is trained.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import cut
from tillroll.llm.spans import apart, digits, find, joined, luhn

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, written so that a scan is linear.  A match
#: starts where a run starts, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Wider candidates.
EMAIL_SPELT = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++"
               r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++")
NUMBER = r"(?<![0-9])[0-9]{13,19}+(?![0-9])"
PHONE_LOCAL = r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

#: Gazetteers and cue words, by kind.
DOMAINS = r"\.(com|org|net|edu|gov|info|io|co|de|fr|es|it|uk|eu)$"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
COUNTRIES = r"^\+(1|33|34|39|44|49)[^0-9]"
CUES = [r"mail|contact|write|reach", r"\bip\b|host|server|addr", r"card|visa|credit|pay|account",
        r"phone|call|tel|fax|mobile|contact"]
OTHER_USE = r"version|isbn|order|serial|build|invoice|release|doi"
VOTES = ["by_pattern", "by_gazetteer", "by_context", "by_edges"]
LENGTHS = 6


def _parts_fit(s: Column) -> Column:
    return F.forall(F.split(s, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) < 4) & F.forall(
        F.split(s, r"\."), lambda p: F.coalesce(F.right(F.concat(F.lit("0"), p), F.lit(9)).cast("int"), F.lit(999)) <= 255)


def _votes(kind: int, c: Column, pattern: Column) -> list[Column]:
    s = c["s"]
    gazetteer = [
        F.when(F.lower(s).rlike(DOMAINS), 1).otherwise(-1),
        F.when(s.rlike(r"^(0|10|127|2[2-5][0-9])\."), -1).otherwise(1),
        F.when(digits(s).rlike(ISSUERS), 1).otherwise(-1),
        F.when(s.rlike(COUNTRIES), 1).otherwise(0)][kind]
    before = F.lower(c["before"])
    context = F.when(before.rlike(CUES[kind]), 1).when(before.rlike(OTHER_USE), -1).otherwise(0)
    left, right = F.right(c["before"], F.lit(1)), F.left(c["after"], F.lit(1))
    edges = (F.when(left.rlike(r"^[\p{L}\p{N}]$") | right.rlike(r"^[\p{L}\p{N}]$"), -1)
              .when(left.rlike(r"^$|\s|[(\[\"'|:]") & right.rlike(r"^$|\s|[)\]\"'|.,;]"), 1).otherwise(0))
    return [pattern, gazetteer, context, edges]


def _judged(kind: int, found: Column, base: bool, pattern) -> Column:
    """Candidates as structs of position, kind, votes and length class."""
    def one(c: Column) -> Column:
        votes = _votes(kind, c, pattern(c))
        size = F.least(F.floor(F.log2(F.length(c["s"]).cast("double"))) - 2, F.lit(LENGTHS - 1))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit(kind).alias("kind"),
                        F.lit(base).alias("base"), F.greatest(size, F.lit(0)).cast("int").alias("size"),
                        *[v.cast("int").alias(n) for v, n in zip(votes, VOTES)])
    return F.transform(found, one)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): all candidates of every document, base ones marked."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = F.col("t")
    number = F.when(t.rlike("[0-9]"), True).otherwise(False)
    rows = rows.withColumn("has_digit", number)
    has = F.col("has_digit")
    n_digits = lambda c: F.length(digits(c["s"]))
    rows = rows.select(
        "doc_id",
        find(t, EMAIL, F.contains(t, F.lit("@"))).alias("email"),
        find(t, EMAIL_SPELT, t.rlike(r"[(\[]at[)\]]")).alias("spelt"),
        find(t, IP, has).alias("quad"),
        F.filter(find(t, CARD, has), lambda c: n_digits(c).between(12, 19)).alias("numbers"),
        find(t, NUMBER, has).alias("runs"),
        F.filter(find(t, PHONE, F.contains(t, F.lit("+"))), lambda c: n_digits(c).between(9, 15)).alias("phone"),
        find(t, PHONE_LOCAL, has).alias("local"))
    rows = rows.select(
        "doc_id", "email", "spelt", "phone", "runs", "local",
        F.filter("quad", lambda c: _parts_fit(c["s"])).alias("ip"),
        F.filter("quad", lambda c: ~_parts_fit(c["s"])).alias("not_ip"),
        F.filter("numbers", lambda c: luhn(digits(c["s"]))).alias("card"))
    yes, unsure, no = (lambda c: F.lit(1)), (lambda c: F.lit(0)), (lambda c: F.lit(-1))
    return rows.select("doc_id", F.concat(
        _judged(0, F.col("email"), True, yes), _judged(0, apart(F.col("spelt"), F.col("email")), False, unsure),
        _judged(1, F.col("ip"), True, yes), _judged(1, F.col("not_ip"), False, no),
        _judged(2, F.col("card"), True, yes),
        _judged(2, apart(F.col("runs"), F.col("card")), False, lambda c: F.when(luhn(c["s"]), 0).otherwise(-1)),
        _judged(3, F.col("phone"), True, yes),
        _judged(3, apart(F.col("local"), F.col("phone")), False, unsure)).alias("found"))


def estimate(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability of every row of counts to be true, by EM: labelers vote
    independently given the truth, with reliabilities of their own."""
    p = np.clip(0.5 + (votes[:, 0] * 2 + votes[:, 1:].sum(axis=1)) / 8, 0.1, 0.9)
    for _ in range(rounds):
        prior = np.array([(n * p)[kind == k].sum() + 1 for k in range(len(KINDS))])
        prior = prior / np.array([n[kind == k].sum() + 2 for k in range(len(KINDS))])
        yes, no = np.log(prior[kind]), np.log(1 - prior[kind])
        for j in range(votes.shape[1]):
            for_yes = np.array([(n * p)[votes[:, j] == v].sum() + 1 for v in (-1, 0, 1)])
            for_no = np.array([(n * (1 - p))[votes[:, j] == v].sum() + 1 for v in (-1, 0, 1)])
            yes = yes + np.log(for_yes / for_yes.sum())[votes[:, j] + 1]
            no = no + np.log(for_no / for_no.sum())[votes[:, j] + 1]
        p = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
    return p


def features(kind, size, votes) -> np.ndarray:
    """One column per kind, length class and labeler's vote for or against."""
    cols = [kind == k for k in range(len(KINDS))] + [size == s for s in range(LENGTHS)]
    cols += [votes[:, j] == v for j in range(votes.shape[1]) for v in (-1, 1)]
    return np.stack(cols, axis=1).astype("f8")


def train(x: np.ndarray, p: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels with counts, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - q)) - ridge * w
        curve = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _score(c: Column, w: np.ndarray) -> Column:
    fits = [c["kind"] == k for k in range(len(KINDS))] + [c["size"] == s for s in range(LENGTHS)]
    fits += [c[v] == x for v in VOTES for x in (-1, 1)]
    total = F.lit(0.0)
    for fit, weight in zip(fits, w):
        total = total + F.when(fit, F.lit(float(weight))).otherwise(F.lit(0.0))
    return total


def private_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): structs (start, end, kind, base, score) per document,
    ``kind`` being a place in KINDS and ``score`` the classifier's log-odds."""
    found = cut(candidates(docs, doc_id, text), "pii-candidates")
    each = found.select(F.explode("found").alias("c")).select("c.*")
    rows = each.groupBy("kind", "size", *VOTES).agg(F.count(F.lit(1)).alias("n")).collect()
    w = np.zeros(len(KINDS) + LENGTHS + 2 * len(VOTES))
    if rows:
        rows = sorted(rows)
        kind, size, n = (np.array([r[c] for r in rows]) for c in ("kind", "size", "n"))
        votes = np.array([[r[v] for v in VOTES] for r in rows])
        # Length classes share their votes' probability.
        w = train(features(kind, size, votes), estimate(kind, votes, n), n)
    kept = F.filter(F.transform("found", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base"),
        _score(c, w).alias("score"))), lambda c: c["base"] | (c["score"] > 0))
    return found.select("doc_id", kept.alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts of base spans, their SHA-256 and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(joined(base, KINDS), 256).alias("base_sha256"),
                        joined(F.col("spans"), KINDS).alias("spans"))
