"""Orders data-quality gate.

A row is *valid* when none of the required columns is NULL and it ranks
first among the rows of its key, ordered by parsed purchase time (NULL and
unparseable times first) and then by every other column.  Everything else is
quarantined, tagged with why: ``null:<first NULL required column>`` or
``duplicate``.  The rank is taken over all rows before the NULL test, so an
incomplete row that ranks first sends its complete twin to quarantine too.

Scale design
------------
* The survivor of each key comes from ``row_number() == 1``, which Catalyst
  plans as a partial per-key limit *before* the shuffle: a key holding a
  third of the table still reaches the reducer as one row per map task.
* Identical complete copies are collapsed by an aggregation on the full row
  (map-side partial aggregation), and the survivor is marked by folding it
  into the same aggregation — no join, no per-row rank over a whole group.
  Copies are expanded again only at the end, in chunks spread over the
  cluster (``replicate_rows``).  Incomplete rows skip all of it: they are
  quarantined whatever their rank.
* NULL keys never enter the ranking: they fail the NULL test whatever their
  rank, and as one window group they would all land in one task.
* Where rows have an identity (file and place in it, see
  ``sources.parquet.read_identified``), nothing is collapsed or expanded:
  ``first_of_repeated`` finds the keys that occur more than once from the key
  column alone, ranks only their rows, and every row is tagged in one left join
  with that (usually small) table.  Spark broadcasts it if its measured size
  allows; else both sides are dealt for the join, hot keys split.
* A stage that has counted the rows per hash class of the key beforehand needs
  that only for the classes with very many rows: all other keys are ranked by a
  window, which deals the rows once (``tag_by_class``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions import any_null, first_null_reason, parse_ts, replicate_rows, sort_key
from tillroll.operators.joins import fresh_key, key_class, left_join_unique
from tillroll.session import shared_dir

# fixed values: columns every order must have (reference gate)
REQUIRED_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
]

KEY = "order_id"
IDENTITY = "_row"
ORDER_COL = "order_purchase_timestamp"
REASON = "dq_reason"
DUPLICATE = "duplicate"


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Fail fast, listing every missing column (F1).  Schema only, no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")


def null_violations(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows failing the NULL test, with the first NULL column's tag (F2)."""
    require_columns(df, required)
    return (df.filter(any_null(required))
              .withColumn(REASON, first_null_reason(required)))


def _ties(df: DataFrame, key: str, tie_break: Sequence[str] | None, identity: str | None = None) -> list[str]:
    return list(tie_break) if tie_break is not None else [c for c in df.columns if c not in (key, identity)]


def rank_window(df: DataFrame, key: str = KEY, order_col: str | None = ORDER_COL,
                tie_break: Sequence[str] | None = None) -> Window:
    """Window of the gate's rank: per key, earliest parsed time first."""
    return Window.partitionBy(key).orderBy(*sort_key(order_col, _ties(df, key, tie_break)))


def survivors(df: DataFrame, key: str = KEY, order_col: str | None = ORDER_COL,
              tie_break: Sequence[str] | None = None) -> DataFrame:
    """First-ranked row of every non-NULL key (complete or not)."""
    w = rank_window(df, key, order_col, tie_break)
    return (df.filter(F.col(key).isNotNull())
              .withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def gate_counts(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = KEY,
                order_col: str | None = ORDER_COL,
                tie_break: Sequence[str] | None = None) -> DataFrame:
    """Distinct *complete* rows with how many copies are valid and duplicates.

    Output: the input columns, ``_valid`` (0/1) and ``_quarantined`` (the
    remaining copies, all ``duplicate``).  The survivors are ranked over every
    row (an incomplete row can outrank a complete one), but only complete rows
    are aggregated: incomplete rows are quarantined whatever their rank.
    """
    require_columns(df, required)
    cols = df.columns
    complete = ~any_null(required)
    first = survivors(df, key, order_col, tie_break).filter(complete)
    marked = (df.filter(complete).select(*cols, F.lit(1).alias("_n"), F.lit(0).alias("_first"))
                .unionByName(first.select(*cols, F.lit(0).alias("_n"), F.lit(1).alias("_first")))
                .groupBy(*cols)
                .agg(F.sum("_n").alias("_n"), F.max("_first").alias("_valid")))
    return marked.select(*cols, F.col("_valid"), (F.col("_n") - F.col("_valid")).alias("_quarantined"))


def first_of_repeated(df: DataFrame, key: str = KEY, order_col: str | None = ORDER_COL,
                      tie_break: Sequence[str] | None = None, identity: str = IDENTITY) -> DataFrame:
    """(key, _first): the identity of the first-ranked row of every key that
    occurs more than once; copies of one row rank by their identities.

    Counting reads the key column only.  The rows of the repeated keys are
    reduced map-side, so a key with a third of the table is one row per task.
    """
    keys = df.filter(F.col(key).isNotNull())
    repeated = (keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                    .select(fresh_key(F.col(key)).alias("_key")))
    rank = [parse_ts(order_col) if order_col else F.lit(None).cast("timestamp_ntz"),
            *[F.col(c) for c in _ties(df, key, tie_break, identity)], F.col(identity)]
    rank = [c.alias(f"_{i}") for i, c in enumerate(rank)]
    rows = keys.withColumn("_key", F.col(key)).join(repeated, "_key", "left_semi")
    first = rows.groupBy(key).agg(F.min(F.struct(*rank)).alias("_min"))
    return first.select(key, F.col("_min")[f"_{len(rank) - 1}"].alias("_first"))


def tag_identified(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = KEY,
                   order_col: str | None = ORDER_COL, tie_break: Sequence[str] | None = None,
                   identity: str = IDENTITY) -> DataFrame:
    """``tag_orders`` of rows with an ``identity`` column, which is left out.

    One pass over the rows: a row is a duplicate if its key is repeated and
    another row of it ranks first.
    """
    require_columns(df, required)
    first = first_of_repeated(df, key, order_col, tie_break, identity)
    tagged = left_join_unique(df, first, key, [identity])
    duplicate = F.col("_first").isNotNull() & (F.col("_first") != F.col(identity))
    reason = F.coalesce(first_null_reason(required), F.when(duplicate, F.lit(DUPLICATE)))
    return tagged.select(*[c for c in df.columns if c != identity], reason.alias(REASON))


def tag_by_class(df: DataFrame, classes: Sequence[int], required: Sequence[str] = REQUIRED_COLUMNS,
                 key: str = KEY, order_col: str | None = ORDER_COL, tie_break: Sequence[str] | None = None,
                 identity: str = IDENTITY) -> DataFrame:
    """``tag_identified`` where ``classes`` are the key's hot ones
    (``joins.hot_classes``): only their rows are tagged that way.

    The others are dealt by key once and ranked where they lie.  That needs no
    identity: of identical copies it does not matter which one is valid.
    """
    require_columns(df, required)
    apart = key_class(key).isin(list(classes))
    rows = df.drop(identity)
    rank = F.row_number().over(rank_window(rows, key, order_col, tie_break))
    near = (rows.filter(~apart) if classes else rows).withColumn("_rn", rank)
    reason = F.coalesce(first_null_reason(required), F.when(F.col("_rn") > 1, F.lit(DUPLICATE)))
    near = near.select(*rows.columns, reason.alias(REASON))
    if not classes:
        return near
    return near.unionByName(tag_identified(df.filter(apart), required, key, order_col, tie_break, identity))


def tag_orders(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = KEY,
               order_col: str | None = ORDER_COL,
               tie_break: Sequence[str] | None = None, identity: str = IDENTITY) -> DataFrame:
    """Every input row once, plus ``dq_reason`` (NULL = valid).

    Rows with an ``identity`` column are tagged in one pass.  Without one,
    identical copies cannot be told apart: incomplete rows pass straight
    through with their NULL tag — no shuffle, so even a third of the table
    with a NULL key never meets in one task — and complete rows go through
    ``gate_counts`` and are expanded back to copies.
    """
    if identity in df.columns:
        return tag_identified(df, required, key, order_col, tie_break, identity)
    counts = gate_counts(df, required, key, order_col, tie_break)
    cols = df.columns
    parts = F.array(
        F.struct(F.lit(None).cast("string").alias(REASON), F.col("_valid").cast("long").alias("_k")),
        F.struct(F.lit(DUPLICATE).alias(REASON), F.col("_quarantined").cast("long").alias("_k")),
    )
    pairs = counts.select(*cols, F.inline(parts)).filter(F.col("_k") > 0)
    incomplete = df.filter(any_null(required)).withColumn(REASON, first_null_reason(required))
    return replicate_rows(pairs, "_k").unionByName(incomplete)


def valid_orders(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = KEY,
                 order_col: str | None = ORDER_COL,
                 tie_break: Sequence[str] | None = None) -> DataFrame:
    """Complete, first-ranked rows: one per key, input schema."""
    require_columns(df, required)
    return survivors(df, key, order_col, tie_break).filter(~any_null(required))


def quarantined_orders(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = KEY,
                       order_col: str | None = ORDER_COL,
                       tie_break: Sequence[str] | None = None) -> DataFrame:
    """Incomplete or not-first rows with their ``dq_reason``."""
    return tag_orders(df, required, key, order_col, tie_break).filter(F.col(REASON).isNotNull())


def gate_summary(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = KEY,
                 order_col: str | None = ORDER_COL,
                 tie_break: Sequence[str] | None = None) -> DataFrame:
    """Row counts per outcome and reason.

    Output: ``outcome`` ('valid' | 'quarantined'), ``dq_reason`` (NULL for
    valid), ``row_count`` (bigint).  Identified rows are tagged and counted.
    Without identities counting needs no full-row aggregation either:
    incomplete rows are counted by their first NULL column, valid rows are
    the complete survivors, and duplicates are the complete rows that are
    not valid — one small aggregation over the rows and the survivors.
    """
    require_columns(df, required)
    if IDENTITY in df.columns:
        reasons = tag_identified(df, required, key, order_col, tie_break).groupBy(REASON)
        outcome = F.when(F.col(REASON).isNull(), "valid").otherwise("quarantined")
        return reasons.agg(F.count(F.lit(1)).alias("row_count")).select(outcome.alias("outcome"), REASON, "row_count")
    complete = ~any_null(required)
    rows = df.select(first_null_reason(required).alias(REASON),
                     F.lit(1).alias("_rows"), F.lit(0).alias("_valid"))
    valid = (survivors(df, key, order_col, tie_break).filter(complete)
             .select(F.lit(None).cast("string").alias(REASON), F.lit(0).alias("_rows"),
                     F.lit(1).alias("_valid")))
    per_reason = (rows.unionByName(valid).groupBy(REASON)
                  .agg(F.sum("_rows").cast("long").alias("_rows"),
                       F.sum("_valid").cast("long").alias("_valid")))
    incomplete = F.col(REASON).isNotNull()
    pairs = per_reason.select(F.inline(F.array(
        F.struct(F.lit("valid").alias("outcome"), F.lit(None).cast("string").alias(REASON),
                 F.col("_valid").alias("row_count")),
        F.struct(F.lit("quarantined").alias("outcome"),
                 F.coalesce(F.col(REASON), F.lit(DUPLICATE)).alias(REASON),
                 F.when(incomplete, F.col("_rows")).otherwise(F.col("_rows") - F.col("_valid"))
                  .alias("row_count")),
    )))
    return pairs.filter(F.col("row_count") > 0)


def rank_orders(df: DataFrame, key: str = KEY, order_col: str | None = ORDER_COL,
                tie_break: Sequence[str] | None = None, rank_col: str = "_row_num") -> DataFrame:
    """Every input row with its rank inside its key, NULL key included.

    Same order as the gate.  A dense rank of every row needs each key's rows
    in order, which a plain window would do in one task per key.  Instead:
    copies are collapsed with a count; the distinct rows are range-partitioned
    on the sort order (sampling splits a hot key over many partitions);
    ranks are counted inside each (range partition, key) piece; and each
    piece is offset by the row counts of the same key in earlier range
    partitions — a table of at most one row per (partition, key) piece.

    Both branches must see the same range partitions, whose bounds come from
    sampling; so the partitioned rows are checkpointed once (a job, written
    to the session's shared ``spark.checkpoint.dir``) and both read that.
    """
    cols = df.columns
    ties = _ties(df, key, tie_break)
    with_ts = df.withColumn("_ts", parse_ts(order_col) if order_col else F.lit(None))
    within = [F.col("_ts").asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in ties]
    versions = with_ts.groupBy(*cols, "_ts").agg(F.count(F.lit(1)).alias("_n"))
    shared_dir(df.sparkSession)
    ordered = (versions.orderBy(F.col(key).asc_nulls_first(), *within)
                       .withColumn("_part", F.spark_partition_id())
                       .checkpoint(eager=True))
    before = Window.partitionBy("_part", key).orderBy(*within).rowsBetween(Window.unboundedPreceding, -1)
    local = ordered.withColumn("_local", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ordered.groupBy("_part", key).agg(F.sum("_n").alias("_t"))
                      .withColumn("_off", F.coalesce(F.sum("_t").over(earlier), F.lit(0)))
                      .select(F.col("_part").alias("_p2"), F.col(key).alias("_k2"), "_off"))
    joined = local.join(offsets, (F.col("_part") == F.col("_p2")) & F.col(key).eqNullSafe(F.col("_k2")))
    starts = joined.select(*cols, "_n", (F.col("_off") + F.col("_local")).alias("_start"))
    copies = replicate_rows(starts, "_n", index_col="_i")
    return copies.select(*cols, (F.col("_start") + F.col("_i")).cast("int").alias(rank_col))


def split_orders(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) with the input schema on both sides (reference form)."""
    tagged = tag_orders(df, **kw)
    return (tagged.filter(F.col(REASON).isNull()).drop(REASON),
            tagged.filter(F.col(REASON).isNotNull()).drop(REASON))
