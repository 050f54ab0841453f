"""Operator 5: URL filter.

A blocked Bloom filter of the listed canonical URLs (512-bit blocks of eight
64-bit lanes, one bit per lane) lets most pages through without a shuffle.
Possible hits go on to an exact join with the list, which removes the false
positives.  Explicit (host, path) rules override the list.

Defined results: a NULL url, or one without ``://``, has empty host and path,
fits no rule and is allowed.  Repeated pages give repeated rows.  An empty
list blocks nothing.  Columns other than the id and the url are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import ascii_lower, cut

#: Fixed values of the query: (verdict, rule), a rule being host and path.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
#: Host words of the categories whose pages the query lists.
LIST_TERMS = ["adult", "bets", "casino", "pills", "spam"]

LANES = 8
BITS_PER_URL = 16
#: The filter has at most this many 64-byte blocks (8 MB), whatever the list;
#: a longer list raises the share of false positives, not the size.
MAX_BLOCKS = 1 << 17


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without trailing slashes or
    ``.html``, and the query without ``utm_`` parameters; no scheme, no
    fragment.  Empty when there is no ``://``."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^#]*", 0)
    query = F.regexp_extract(rest, r"^[^?]*\??(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/+$", ""), r"\.html$", "")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULLs."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _lane_bits(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(LANES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def bloom_blocks(n_keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    return max(1, min(max_blocks, -(-n_keys * BITS_PER_URL // (64 * LANES))))


def build_bloom(keys: DataFrame, col: str, blocks: int) -> DataFrame:
    """One row per non-empty block: (bloom_block, lane_0 .. lane_7)."""
    bits = _lane_bits(F.col(col))
    one = F.lit(1).cast("bigint")
    return (keys.where(F.col(col).isNotNull())
                .groupBy(_block(F.col(col), blocks).alias("bloom_block"))
                .agg(*[F.bit_or(F.call_function("shiftleft", one, b)).alias(f"lane_{i}")
                       for i, b in enumerate(bits)]))


def possible_hits(df: DataFrame, col: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``df`` with boolean ``possible``: false is certain, true needs a check.

    ``bloom`` has at most ``blocks`` <= MAX_BLOCKS rows of 72 bytes, so it is
    broadcast.
    """
    names = df.columns
    found = F.lit(True)
    for i, b in enumerate(_lane_bits(F.col(col))):
        found = found & (F.call_function("getbit", F.col(f"lane_{i}"), b) == 1)
    return (df.withColumn("bloom_block", _block(F.col(col), blocks))
              .join(F.broadcast(bloom), "bloom_block", "left")
              .select(*names, F.coalesce(found, F.lit(False)).alias("possible")))


def url_filter(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]] = RULES,
               page_id: str = "page_id", url: str = "url", listed_url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    ``listed`` holds the URLs to block; both sides are made canonical.
    """
    urls = (listed.select(canonical(F.col(listed_url)).alias("canon"))
                  .where("canon <> ''").distinct())
    urls = cut(urls, "url-list")
    blocks = bloom_blocks(urls.count())
    # The list and the filter are tables of their own, so that Spark can deal
    # a URL with very many pages over several tasks of the join.
    bloom = build_bloom(urls, "canon", blocks)
    u = F.col(url)
    base = pages.select(F.col(page_id).alias("page_id"), host_of(u).alias("host"),
                        path_of(u).alias("path"), canonical(u).alias("canon"))
    base = base.withColumns({"host": F.coalesce("host", F.lit("")),
                             "path": F.coalesce("path", F.lit("")),
                             "canon": F.coalesce("canon", F.lit(""))})
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "said": said})
    probed = possible_hits(base, "canon", bloom, blocks)
    ask = F.col("possible") & F.col("said").isNull()
    out = ["page_id", "host", "path", "rule"]
    settled = (probed.where(~ask)
               .select(*out, F.coalesce("said", F.lit("allow")).alias("verdict")))
    hits = (probed.where(ask)
            .join(urls.withColumn("listed", F.lit(True)), "canon", "left")
            .select(*out, F.when(F.col("listed"), "block").otherwise("allow").alias("verdict")))
    return settled.unionByName(hits)


def listed_by_terms(pages: DataFrame, terms: list[str] = LIST_TERMS, url: str = "url") -> DataFrame:
    """URLs of the pages whose host has one of ``terms`` as a word of a label."""
    words = r"(^|[.-])(" + "|".join(terms) + r")($|[.-])"
    return pages.select(F.col(url).alias("url")).where(host_of(F.col(url)).rlike(words))
