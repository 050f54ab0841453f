"""Operator 6: n-gram Jaccard join.

1. Each text becomes its sorted set of shingle hashes.  Texts with equal sets
   form a class, and only classes go on.
2. Sets fall into bands by size, so that a link joins equal or neighbouring
   bands.  A set differs from any that it links with in at most d shingles, so
   in at most d of the parts into which its band cuts the hash range.  Of the
   first d + 1 parts in one order for all sets one therefore agrees, and classes
   that agree in one of these are candidates.  Parts with most shingles come
   first: a shingle that many texts share brings nothing together by itself.
   Bands have parts enough that d + 1 hold something; the rare set with fewer
   gives all its parts, empty ones too.
3. In a group of candidates all are first held against the one that agrees
   most often.  Then only groups that still hold several components are
   compared, block by block: a block pair reports, of the pairs whose signatures
   allow a link, a spanning forest of the components, so at most one per row.
   These are verified, and as long as any of them fails, its groups are
   compared again without it, for twice as many forests each time, FORESTS at
   most: few turns, and so few queries, whose plans the driver keeps.  From the
   second turn on, rows of a group that have no such pair left leave it.
4. Signatures hold the parity of the hashes in each of a number of bits that
   grows with the set: the bits in which two differ are a lower bound of the
   shingles in which the sets differ, and so bound the overlap from above.
   Pairs that pass are intersected exactly, as sorted arrays: first each
   class's closest pair, then those whose ends are still apart.

No pair that could link two components is dropped, and what any step reports
grows with a group's rows, not with its pairs.  A row of a group goes to one
task per block of the group.

Defined results: NULL texts and texts without words have no shingles and link
with nothing; fewer words than a shingle form one.  Repeated rows are links of
their own; a component's id is its smallest doc_id (NULL only if all are).  An
empty table gives no rows.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.common import cut, lean, ship
from tillroll.llm.graph import components
from tillroll.llm.url_filter import bloom_blocks, build_bloom, possible_hits
from tillroll.llm.tokens import pieces
from tillroll.llm.words import SPACES, mix, shingles, word_hashes

SETS = "doc_id long, n_shingles long, digest binary, keys binary, bits binary"
FULL = "doc_id long, digest binary, shingles binary"
#: Least bits of a signature, and bits per shingle from which on it grows.
SIGNATURE_BITS, BITS_PER_SHINGLE = 1024, 2
#: A band has parts until a set has d + 1 that are not empty even if it has so
#: many standard deviations fewer than others of its size.
DEVIATIONS = 4
#: Candidates of one group that are compared together, on average.
BLOCK = 2048
#: Most forests, none with a pair of another, of one block pair in one turn.
FORESTS = 8


class Tiles:
    """Bands of set sizes: where each begins, and its parts of the hash range."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.parts = [1], []

    def most(self, n, m):
        """The most shingles in which linked sets of n and m differ."""
        return (n + m) * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(band, parts, d) of the bands in which a set of ``n`` shingles looks
        for others: its own, and the one below if a link reaches there."""
        while self.low[-1] <= n:
            x = self.low[-1]
            self.low.append(max(2 * x, -(-x * 100 // self.percent)))
            self.parts.append(self._parts_for(x, self.low[-1] - 1))
        band = bisect.bisect_right(self.low, n) - 1
        out = [(band, self.parts[band], self.most(n, n * 100 // self.percent))]
        below = self.low[band] - 1
        if below and 100 * below >= self.percent * n:
            out.append((band - 1, self.parts[band - 1], self.most(n, below)))
        return out

    def _parts_for(self, low: int, high: int) -> int:
        """The fewest parts, about, of which sets of ``low`` to ``high`` shingles
        fill d + 1.  Larger ones that look here fill more and differ in no more."""
        n = np.unique(np.linspace(low, high, 64).astype("i8"))
        d = self.most(n, n * 100 // self.percent)
        parts = int(d[-1]) + 2
        while parts < 8 * int(d[-1]) + 64:
            empty = parts * (1 - 1 / parts) ** n
            spread = empty + parts * (parts - 1) * (1 - 2 / parts) ** n - empty ** 2
            if (parts - empty - DEVIATIONS * np.sqrt(np.maximum(spread, 0)) >= d + 1).all():
                break
            parts += 1 + parts // 50
        return parts


def digest_of(s: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    return (mix(s).sum(dtype="u8").tobytes()
            + mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype="u8").tobytes())


def part_keys(s: np.ndarray, tiles: Tiles) -> np.ndarray:
    """Keys of the parts of the sorted set ``s`` that it is found by."""
    total = np.concatenate([np.zeros(1, "u8"), np.cumsum(mix(s ^ np.uint64(0x5851F42D4C957F2D)))])
    top = (s >> np.uint64(32)).astype("u8")
    out = []
    for band, parts, d in tiles.of(len(s)):
        if d == 0:
            continue            # only equal sets link there
        of = ((top * np.uint64(parts)) >> np.uint64(32)).astype("i8")
        edge = np.searchsorted(of, np.arange(parts + 1))
        count = np.diff(edge)
        key = mix(total[edge[1:]] - total[edge[:-1]] + mix(np.uint64(band << 32) + np.arange(parts, dtype="u8")))
        full = np.flatnonzero(count)
        if len(full) > d:
            # One order for all sets: by shingles in a part, then by key.
            key = key[full[np.lexsort((key[full], -count[full]))[:d + 1]]]
        out.append(key)
    return np.concatenate(out) if out else np.empty(0, "u8")


def signature(s: np.ndarray) -> bytes:
    size = max(SIGNATURE_BITS, 1 << (BITS_PER_SHINGLE * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype("i8"), minlength=size) & 1
    return np.packbits(odd.astype("u1")).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A signature as the words of one of ``size`` bytes: parities of more
    bits add up to parities of fewer."""
    words = np.frombuffer(bits, "u8")
    return np.bitwise_xor.reduce(words.reshape(-1, size // 8), axis=0)


def differing(x: bytes, y: bytes) -> int:
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def _sets(batch: pa.RecordBatch, k: int):
    for _, texts in pieces(batch.column(1)):
        hashes, starts, _ = word_hashes(texts, SPACES)
        for i in range(len(texts)):
            yield np.unique(shingles(hashes[starts[i]:starts[i + 1]], k))


def _read_sets(k: int, percent: int):
    def run(batches):
        tiles = Tiles(percent)
        for batch in batches:
            n, out = [], [[], [], []]
            for s in _sets(batch, k):
                n.append(len(s))
                row = (digest_of(s), part_keys(s, tiles).tobytes(), signature(s)) if len(s) else (None,) * 3
                for col, x in zip(out, row):
                    col.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in out]],
                names=["doc_id", "n_shingles", "digest", "keys", "bits"])
    return run


def _full_sets(k: int):
    def run(batches):
        for batch in batches:
            sets = list(_sets(batch, k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([f(s) for s in sets], pa.binary())
                                     for f in (digest_of, np.ndarray.tobytes)],
                names=["doc_id", "digest", "shingles"])
    return run


def _spread_keys(batches):
    for batch in batches:
        size = [len(x.as_buffer()) // 8 for x in batch.column(1)]
        keys = np.frombuffer(b"".join(x.as_py() for x in batch.column(1)), "i8")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), size))), pa.array(keys)],
            names=["class", "key"])


def overlap_bound(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Most common elements of sets of n and m whose signatures differ so."""
    return np.minimum((n + m - differ) // 2, np.minimum(n, m))


def _possible(percent: int):
    """Pairs whose signatures allow a link, and the bits in which they differ."""
    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in (2, 3))
            differ = np.array([differing(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))], "i8")
            most = overlap_bound(n, m, differ)
            keep = pa.array(100 * most >= percent * (n + m - most))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).filter(keep) for c in (0, 1)], pa.array(differ).filter(keep)], names=["a", "b", "differ"])
    return run


def _linked(percent: int):
    """Pairs whose sets link, by exact intersection."""
    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), "u8") for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in (0, 1)], names=["a", "b"])
    return run


def _with_ends(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of both classes."""
    for end in ("a", "b"):
        pairs = pairs.join(table.select(F.col("class").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return pairs.select("a", "b", *[f"{c}_{end}" for c in columns for end in ("a", "b")])


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link.  Sets are read again from
    the texts, of the classes that occur in ``pairs`` only: a Bloom filter of
    their documents spares the rest the shuffle."""
    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = cut(ends.join(classes.select("class", "digest", "doc_id"), "class"), "wanted")
    blocks = bloom_blocks(wanted.count())
    near = possible_hits(docs, "doc_id", build_bloom(wanted, "doc_id", blocks), blocks)
    near = near.where(F.col("possible") | F.col("doc_id").isNull())
    full = (near.select("doc_id", "text").mapInArrow(lean(_full_sets(k)), FULL)
                .join(wanted.select("class", "digest"), "digest").dropDuplicates(["class"]))
    full = cut(full.select("class", "shingles"), "full-sets")
    return cut(_with_ends(pairs, full, ["shingles"]).mapInArrow(lean(_linked(percent)), "a long, b long"), "links")


def _block_forest(percent: int, forests: int = 1, rest: bool = False):
    """Of one block of a group against one block: pairs (a, b) whose signatures
    allow a link, that were not tried before, and that would join components;
    those of each of ``forests`` close no circle.  With ``rest`` also (a, NULL)
    of every row that has such a pair beside those reported."""
    def run(key, rows):
        side, name, root, n, bits, tried = (rows[c].to_pylist() for c in ("side", "class", "root", "n", "bits", "tried"))
        place = {x: i for i, x in enumerate(dict.fromkeys(root))}
        roots = np.array([place[x] for x in root], "i8")
        left = [i for i, s in enumerate(side) if s == 0]
        right = np.array([i for i, s in enumerate(side) if s == 1] or left, "i8")
        place = {x: i for i, x in enumerate(name)}
        known: dict[int, list[int]] = {}
        for i, others in enumerate(tried):
            for j in (place[x] for x in others or () if x in place):
                known.setdefault(i, []).append(j)
                known.setdefault(j, []).append(i)
        size = np.asarray(n, "i8")
        least = min(map(len, bits))
        sig = np.stack([folded(x, least) for x in bits])
        out = [[], []]

        def partners(i, part):
            """Rows that may link with row i and are not of its component."""
            found = right[part[right] != part[i]]
            if i in known:
                found = np.setdiff1d(found, known[i])
            differ = np.bitwise_count(sig[found] ^ sig[i]).sum(axis=1).astype("i8")
            most = overlap_bound(size[found], size[i], differ)
            can = 100 * most >= percent * (size[found] + size[i] - most)
            return found[can][np.argsort(differ[can], kind="stable")]

        for _ in range(forests if len(right) else 0):
            part, pairs = roots.copy(), []
            for i in left:
                for j in partners(i, part):
                    if part[j] != part[i]:
                        pairs.append((i, int(j)))
                        part[part == part[j]] = part[i]
            if not pairs:
                break
            for i, j in pairs:
                out[0].append(name[i])
                out[1].append(name[j])
                known.setdefault(i, []).append(j)
                known.setdefault(j, []).append(i)
        if rest and len(right):
            still = [(i, partners(i, roots)) for i in left]
            for i in sorted({int(x) for i, js in still if len(js) for x in (i, *js)}):
                out[0].append(name[i])
                out[1].append(None)
        of = pa.array([key[0].as_py() if key else None] * len(out[0]), pa.int64())
        return pa.table([of, *[pa.array(x, rows["class"].type) for x in out]], names=["key", "a", "b"])
    return run


def _open_pairs(groups: DataFrame, roots: DataFrame, small: DataFrame, failed: DataFrame, percent: int,
                forests: int = 1, rest: bool = False) -> DataFrame:
    """(key, a, b): pairs within a group that may link components, ``forests``
    per block pair; none of ``failed`` (a, b).  ``rest``: see _block_forest."""
    rows = (groups.join(roots.withColumnRenamed("node", "class"), "class", "left")
                  .withColumn("root", F.coalesce("root", "class")))
    split = (rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
                 .where("low < high").select("key", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    rows = rows.select("key", "class", "root").join(cut(split, "open-groups"), "key")
    tried = failed.groupBy(F.col("a").alias("class")).agg(F.collect_set("b").alias("tried"))
    rows = rows.join(small, "class").join(tried, "class", "left")
    # Block i meets blocks i .. blocks - 1: as the left side of (i, j), as the
    # right side of (j, i).
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), "blocks"))
    cells = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(
        F.least("block", j).alias("i"), F.greatest("block", j).alias("j"),
        F.when(F.col("block") <= j, 0).otherwise(1).alias("side"))))
    rows = rows.withColumn("cell", cells).select(
        "key", "cell.i", "cell.j", "cell.side", "class", "root", "n", "bits", "tried")
    kind = small.schema["class"].dataType.simpleString()
    return rows.groupBy("key", "i", "j").applyInArrow(_block_forest(percent, forests, rest), f"key long, a {kind}, b {kind}")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    for end in ("a", "b"):
        pairs = (pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias("at")), end, "left")
                      .withColumn(f"root_{end}", F.coalesce("at", end)).drop("at"))
    return pairs.where(F.col("root_a") != F.col("root_b")).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 90, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Two texts link when 100 * |intersection| >= percent * |union| of their sets
    of ``k``-word shingles.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = docs.mapInArrow(lean(_read_sets(k, percent)), SETS)
    sets = cut(sets.withColumn("row", F.monotonically_increasing_id()), "sets")
    some = sets.where(F.col("digest").isNotNull()).groupBy("digest")
    # From here on a class goes by the number of its first row.
    classes = cut(some.agg(F.min("row").alias("class"), F.min("doc_id").alias("doc_id"),
                           F.first("n_shingles").alias("n"), F.first("bits").alias("bits")), "classes")
    spread = (some.agg(F.min("row").alias("class"), F.first("keys").alias("keys")).select("class", "keys")
                  .mapInArrow(lean(_spread_keys), "class long, key long"))
    groups = (spread.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key")))
                    .where("size > 1"))
    groups = cut(groups, "groups")
    often = cut(groups.groupBy("class").agg(F.sum("size").alias("often")), "often")
    small = cut(classes.select("class", "n", "bits").join(often.select("class"), "class", "left_semi"), "signatures")

    hub = cut(groups.join(often, "class").groupBy("key")
              .agg(F.max(F.struct("often", "class"))["class"].alias("hub")), "hubs")
    star = (groups.join(hub, "key").where(F.col("class") != F.col("hub"))
                  .select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct())
    star = cut(_with_ends(star, small, ["n", "bits"])
               .mapInArrow(lean(_possible(percent)), "a long, b long, differ long"), "star-pairs")
    each = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"), "differ"))
    closest = (each.groupBy("a").agg(F.min(F.struct("differ", "b"))["b"].alias("b"))
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = _verified(cut(closest, "closest-pairs"), docs, classes, k, percent)
    roots = components(links)
    failed = cut(_apart(star.select("a", "b"), roots), "star-pairs")
    if not failed.isEmpty():
        links = links.unionByName(_verified(failed, docs, classes, k, percent))
        roots = components(links)
        failed = cut(_apart(failed, roots), "failed-pairs")
    groups, forests = groups.where("size > 2"), 1
    while True:
        # When most components are joined, few rows of a group have pairs left.
        rest = forests > 1
        found = cut(_open_pairs(groups, roots, small, failed, percent, forests, rest), "open-pairs")
        pairs = cut(found.where(F.col("b").isNotNull()).select("a", "b").distinct(), "open-pairs")
        if pairs.isEmpty():
            break
        links = links.unionByName(_verified(pairs, docs, classes, k, percent))
        roots = components(links)
        pairs = cut(_apart(pairs, roots), "failed-pairs")
        if pairs.isEmpty():
            break
        failed = failed.unionByName(pairs)
        if rest:
            groups = found.where(F.col("b").isNull()).select("key", F.col("a").alias("class")).distinct()
        # A group all of whose pairs linked is done.
        again = found.join(pairs, ["a", "b"], "left_semi").select("key").distinct()
        groups = cut(groups.join(again, "key", "left_semi"), "groups")
        forests = min(2 * forests, FORESTS)

    named = (classes.select("class", "digest", "doc_id")
                    .join(roots.withColumnRenamed("node", "class"), "class", "left")
                    .withColumn("root", F.coalesce("root", "class")))
    named = cut(named, "named")
    least = cut(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    named = cut(named.join(least, "root").select("digest", "component_id"), "class-components")
    return (sets.join(named, "digest", "left")
                .select("doc_id", "n_shingles",
                        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                         .alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of one document per component: the
    one with the smallest doc_id.

    Rows that share a doc_id are kept or removed together, and of equal ones
    one is kept; rows without a doc_id are kept.
    """
    found = near_duplicates(docs, k, percent, doc_id, text)
    same = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(
        (F.col("doc_id") == F.col("component_id")).cast("int")).alias("kept"))
    odd = cut(same.where(F.col("doc_id").isNotNull() & ((F.col("kept") == 0) | (F.col("n") > 1)))
              .select(F.col("doc_id").alias("id"), "kept"), "odd-documents")
    blocks = bloom_blocks(odd.count())
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    rows = possible_hits(rows, "id", build_bloom(odd, "id", blocks), blocks)
    plain = rows.where(~F.col("possible"))
    asked = rows.where("possible").join(odd, "id", "left").where(F.coalesce("kept", F.lit(1)) == 1)
    twice = (asked.where(F.col("kept").isNotNull())
                  .withColumn("same", F.sha2(F.coalesce(F.col("row")[text], F.lit("")), 256)).dropDuplicates(["id", "same"]))
    out = plain.select("row").unionByName(asked.where(F.col("kept").isNull()).select("row"))
    return out.unionByName(twice.select("row")).select("row.*")
