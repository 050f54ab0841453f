"""Operator 12: SimHash near duplicates by a binary trie self-join.

1. A text's fingerprint has a bit set where over half of its shingles' hashes
   (XXH64) have it.  Equal fingerprints become one row with their smallest
   doc_id, so copies go on as one.
2. Fingerprints are dealt to tasks as subtries.  Of ``blocks`` blocks of bits,
   two linked fingerprints agree in all but ``errors``; each choice of agreeing
   blocks is one order of the bits, in which these come first.  Under it, a
   subtrie is what shares those first bits, and every linked pair is within
   one subtrie of some order.  The more fingerprints, the more blocks: subtries
   stay small on average.
3. In a task all its subtries are one sorted array, a node being a range of
   it.  Node pairs are traversed together, from each subtrie against itself,
   one bit a step: differing bits add up, and a pair is pruned when they
   exceed ``errors`` or when all its fingerprints are known to be in one
   component.  Small pairs are compared directly.  Pairs wait on a stack and
   are taken up in runs, so memory is bounded.  A task reports a spanning
   forest of the links, never all pairs of a group.
4. A subtrie of more than ``limit`` fingerprints (a large group of near
   copies) does not go to a task.  Its fingerprints are first linked with their
   neighbours in sorted order; if it still has several components, they are
   dealt again with more blocks.  With 12 blocks at 64 bits, two thirds of the
   bits are shared and no subtrie can exceed 2^22 fingerprints.

No link is lost, whatever the group sizes.  Tables are cut between the steps
into the shared folder, so a lost executor costs its tasks only.

Defined results: NULL texts and texts without words have the fingerprint zero
and link like any other; fewer words than a shingle form one; repeated rows are
rows of one component; a component's id is its smallest doc_id (NULL only if
all are); an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import by_size, cut, ship
from tillroll.llm.graph import components
from tillroll.llm.tokens import pieces

BITS, SEED = 64, 42
#: Shingles hashed at once, node pairs taken up at once, and the size from
#: which on a node pair is compared directly.
AT_ONCE, FRONTIER, DIRECT = 1 << 15, 1 << 16, 32
#: Fingerprints of a subtrie that goes to a task; subtries taken up together.
LIMIT = 1 << 15
#: Blocks with which subtries are made, in turn.
BLOCKS = (5, 6, 7, 8, 10, 12)
#: Expected size of a subtrie of evenly spread fingerprints.
SUBTRIE = 64


def fingerprint(words: list[bytes], k: int) -> int:
    """Of words in lower case: one bit per place, set if over half the hashes have it."""
    from xxhash import xxh64_intdigest
    if not words:
        return 0
    text = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    size = min(k, len(words))
    begin = np.concatenate([[0], ends[:-1] + 1])[:len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    ones = np.zeros(BITS, "i8")
    for i in range(0, len(begin), AT_ONCE):
        h = np.array([xxh64_intdigest(text[a:z], SEED) for a, z in zip(begin[i:i + AT_ONCE], ends[i:i + AT_ONCE])], "u8")
        ones += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("u8")[0])


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            out = []
            for _, texts in pieces(batch.column(1)):
                # Splitting bytes, and lowering them, is by ASCII alone.
                out += [fingerprint(t.as_buffer().to_pybytes().lower().split(), k) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(out, "u8").view("i8"))], names=["doc_id", "fp"])
    return run


# -- orders of the bits

def block_edges(blocks: int) -> list[int]:
    return [BITS * i // blocks for i in range(blocks + 1)]


def bit_orders(blocks: int, errors: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Per choice of agreeing blocks: how many bits these have, and the moves
    (from, width, to) of every block, bits counted from the lowest."""
    edges = block_edges(blocks)
    out = []
    for agree in itertools.combinations(range(blocks), blocks - errors):
        rest = [b for b in range(blocks) if b not in agree]
        moves, top = [], BITS
        for b in [*agree, *rest]:
            width = edges[b + 1] - edges[b]
            top -= width
            moves.append((edges[b], width, top))
        out.append((sum(edges[b + 1] - edges[b] for b in agree), moves))
    return out


def reordered(fp: np.ndarray, moves: list[tuple[int, int, int]], back: bool = False) -> np.ndarray:
    out = np.zeros(len(fp), "u8")
    for a, width, z in moves:
        if back:
            a, z = z, a
        out |= ((fp >> np.uint64(a)) & np.uint64((1 << width) - 1)) << np.uint64(z)
    return out


# -- the self-join of one sorted array of subtries

def _roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the components of the pairs; roots are the smallest places."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def _pairs_of(lo1, hi1, lo2, hi2):
    """All pairs of places of each pair of ranges, once each if they are the same."""
    n1, n2 = hi1 - lo1, hi2 - lo2
    count = n1 * n2
    which = np.repeat(np.arange(len(count)), count)
    k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    a, b = lo1[which] + k // n2[which], lo2[which] + k % n2[which]
    keep = a < b                # ranges are the same or the first is before
    return a[keep], b[keep]


def trie_links(fp: np.ndarray, tree: np.ndarray, root: np.ndarray, first_bit: int, errors: int) -> np.ndarray:
    """Roots (places) after linking all pairs within each subtrie of ``errors``
    differing bits at most.  ``fp`` is sorted by subtrie and then by value;
    fingerprints of a subtrie agree in the bits from ``first_bit`` up."""
    n = len(fp)
    near = np.flatnonzero((tree[1:] == tree[:-1]) & (np.bitwise_count(fp[1:] ^ fp[:-1]) <= errors))
    root = _roots(root, near, near + 1)
    ones = {}

    def zeros_end(lo, hi, bit):
        if bit not in ones:
            ones.clear()
            ones[bit] = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype="i8")])
        return hi - (ones[bit][hi] - ones[bit][lo])

    def one_component(lo1, hi1, lo2, hi2):
        same = (changes[hi1 - 1] == changes[lo1]) & (changes[hi2 - 1] == changes[lo2])
        return same & (root[lo1] == root[lo2])

    def changes_of():
        return np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])

    changes = changes_of()
    edge = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1], [True]]))
    lo, hi = edge[:-1], edge[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    waiting = [(first_bit - 1, lo, hi, lo, hi, np.zeros(len(lo), "i1"))]
    while waiting:
        bit, lo1, hi1, lo2, hi2, differ = waiting.pop()
        if len(lo1) > FRONTIER:
            half = len(lo1) // 2
            waiting += [(bit, *(x[half:] for x in (lo1, hi1, lo2, hi2, differ))),
                        (bit, *(x[:half] for x in (lo1, hi1, lo2, hi2, differ)))]
            continue
        keep = (lo1 < hi1) & (lo2 < hi2) & (differ <= errors)
        lo1, hi1, lo2, hi2, differ = (x[keep] for x in (lo1, hi1, lo2, hi2, differ))
        keep = ~one_component(lo1, hi1, lo2, hi2)
        lo1, hi1, lo2, hi2, differ = (x[keep] for x in (lo1, hi1, lo2, hi2, differ))
        if not len(lo1):
            continue
        small = ((hi1 - lo1) * (hi2 - lo2) <= DIRECT) if bit >= 0 else np.ones(len(lo1), bool)
        a, b = _pairs_of(lo1[small], hi1[small], lo2[small], hi2[small])
        linked = np.bitwise_count(fp[a] ^ fp[b]) <= errors
        a, b = a[linked], b[linked]
        if (root[a] != root[b]).any():
            root = _roots(root, a, b)
            changes = changes_of()
        lo1, hi1, lo2, hi2, differ = (x[~small] for x in (lo1, hi1, lo2, hi2, differ))
        if not len(lo1):
            continue
        mid1, mid2 = zeros_end(lo1, hi1, bit), zeros_end(lo2, hi2, bit)
        two = lo1 != lo2            # a node against itself has one mixed pair, not two
        waiting.append((bit - 1,
                        np.concatenate([lo1, mid1, lo1, mid1[two]]), np.concatenate([mid1, hi1, mid1, hi1[two]]),
                        np.concatenate([lo2, mid2, mid2, lo2[two]]), np.concatenate([mid2, hi2, hi2, mid2[two]]),
                        np.concatenate([differ, differ, differ + 1, differ[two] + 1])))
    return root


# -- dealing subtries to tasks

def _keys(blocks: int, errors: int):
    """(key, fp) of each fingerprint under every order of the bits."""
    orders = bit_orders(blocks, errors)

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view("u8")
            for number, (width, moves) in enumerate(orders):
                key = (reordered(fp, moves) >> np.uint64(BITS - width)) | np.uint64(number << 52)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view("i8")), *batch.columns], names=["key", *batch.schema.names])
    return run


def _forest(blocks: int, errors: int):
    """Links of a partition sorted by key, in runs of whole subtries."""
    orders = bit_orders(blocks, errors)

    def links(key, fp, place):
        for number in np.unique(key >> np.uint64(52)):
            mine = key >> np.uint64(52) == number
            width, moves = orders[int(number)]
            tree, value, name, was = key[mine], reordered(fp[mine], moves), fp[mine], place[mine]
            order = np.lexsort((value, tree))
            tree, value, name, was = tree[order], value[order], name[order], was[order]
            # What is in one component already starts from one root.
            _, first, which = np.unique(was, return_index=True, return_inverse=True)
            before = first[which]
            root = trie_links(value, tree, before, BITS - width, errors)
            new = np.flatnonzero(root != before)
            if len(new):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[x].view("i8")) for x in (new, root[new])], names=["a", "b"])

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy().view("u8") for c in ("key", "fp", "root")))
            rows += batch.num_rows
            if rows < LIMIT:
                continue
            key, fp, place = (np.concatenate(x) for x in zip(*held))
            whole = np.searchsorted(key, key[-1])       # the last subtrie may go on
            if whole:
                yield from links(key[:whole], fp[:whole], place[:whole])
            held = [(key[whole:], fp[whole:], place[whole:])]
            rows = len(key) - whole
        if rows:
            yield from links(*(np.concatenate(x) for x in zip(*held)))
    return run


def _neighbours(errors: int):
    """Links of next ones in a sorted partition, whatever its size."""
    def run(batches):
        last = None
        for batch in batches:
            fp = batch.column("fp").to_numpy().view("u8")
            if last is not None:
                fp = np.concatenate([last, fp])
            last = fp[-1:]
            near = np.flatnonzero(np.bitwise_count(fp[1:] ^ fp[:-1]) <= errors)
            yield pa.RecordBatch.from_arrays([pa.array(fp[x].view("i8")) for x in (near, near + 1)], names=["a", "b"])
    return run


def _with_roots(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(fp, root): the component known so far, else itself."""
    if roots is None:
        return rows.withColumn("root", F.col("fp"))
    known = roots.select(F.col("node").alias("fp"), "root")
    return rows.join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def linked_fingerprints(found: DataFrame, errors: int = 4, limit: int = LIMIT) -> DataFrame:
    """(node, root) of the fingerprints (fp, without repeats) that link with another."""
    spark = found.sparkSession
    n = found.count()
    plan = [b for b in BLOCKS if b > errors]
    share = [min(w for w, _ in bit_orders(b, errors)) for b in plan]
    plan = plan[next((i for i, w in enumerate(share) if n >> w <= SUBTRIE), len(plan) - 1):]
    rows, links, roots = found.select("fp"), None, None
    for turn, blocks in enumerate(plan):
        keyed = cut(_with_roots(rows, roots).select("fp", "root")
                    .mapInArrow(_keys(blocks, errors), "key long, fp long, root long"), "subtries")
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"),
                                         F.max("root").alias("high"))
        # A subtrie of one, or in one component, has nothing to find.
        sizes = sizes.where("size > 1 and low < high")
        small = sizes if blocks == plan[-1] else sizes.where(F.col("size") <= limit)
        forest = (keyed.join(small.select("key"), "key", "left_semi")
                       .repartition(by_size(spark), "key").sortWithinPartitions("key")
                       .mapInArrow(_forest(blocks, errors), "a long, b long"))
        forest = cut(forest, "forest")
        links = forest if links is None else links.unionByName(forest)
        if blocks == plan[-1]:
            break
        large = cut(sizes.where(F.col("size") > limit).select("key"), "large-subtries")
        if large.isEmpty():
            break
        rows = cut(keyed.join(large, "key", "left_semi").select("fp").distinct(), "large-fingerprints")
        near = rows.repartitionByRange(by_size(spark), "fp").sortWithinPartitions("fp")
        links = links.unionByName(cut(near.mapInArrow(_neighbours(errors), "a long, b long"), "neighbours"))
        roots = components(links)
    return components(links)


def near_duplicates(docs: DataFrame, k: int = 4, errors: int = 4, limit: int = LIMIT,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Texts link when the fingerprints of their ``k``-word shingles differ in
    ``errors`` bits at most; the id is the smallest one reachable by links.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = cut(rows.mapInArrow(_fingerprints(k), "doc_id long, fp long"), "fingerprints")
    each = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "each-fingerprint")
    roots = linked_fingerprints(each, errors, limit)
    named = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = cut(named, "rooted")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(named.join(least, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
