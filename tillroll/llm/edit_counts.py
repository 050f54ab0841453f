"""Operator 10: token counts that follow edits.

A document is cut at white space into leaves of up to LEAF pre-token runs.
Tokens never reach across white space, so a leaf counts on its own.  Code
points and tokens of the leaves are summed in a binary segment tree per
document, stored as arrays in heap order: node i has children 2i and 2i + 1,
leaf k is node size + k, node 1 the whole document.

An edit replaces text[start:end].  It finds its leaves by descending along the
sums of code points; only these are cut, joined with the replacement and
encoded again, with the next leaf where the edit removed the white space
between the two (the boundary context), and the sums above them are updated.

Edits of a document count from its text before any of them.  They are applied
in order of (start, end, replacement); one that overlaps the edit before it
starts where that one ends; offsets beyond the text are its end; NULL offsets
make no edit, a NULL replacement is empty.

Defined results: NULL and empty texts have a tree of one empty leaf.  Documents
without edits keep their counts.  Repeated rows are counted each.  An empty
table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import ship
from tillroll.llm.pii import EMAIL
from tillroll.llm.spans import find
from tillroll.llm.tokens import default_vocabulary, encoder, row_slices

LEAF = 16
WHITE = " \t\n\x0b\x0c\r"
_LEAVES = re.compile(f"(?:[^{WHITE}]*[{WHITE}]+){{1,{LEAF}}}|[^{WHITE}]+")
TREE = "chars array<long>, tokens array<long>"
EDITS = "array<struct<start:bigint,end:bigint,replacement:string>>"
COUNTS = ("doc_id long, n_edits long, tokens_before long, tokens_after long, chars_after long, "
          "chars_encoded long, new_text string, " + TREE)


def heap(leaves: np.ndarray) -> np.ndarray:
    """Sums in heap order over the leaves, their number rounded up to a power of two."""
    size = 1 << max(0, int(len(leaves) - 1).bit_length()) if len(leaves) else 1
    tree = np.zeros(2 * size, "i8")
    tree[size:size + len(leaves)] = leaves
    while size > 1:
        size //= 2
        tree[size:2 * size] = tree[2 * size:4 * size:2] + tree[2 * size + 1:4 * size:2]
    return tree


class Document:
    """A text with its two trees, under edits from right to left."""

    def __init__(self, text: str, chars, tokens, count):
        self.text, self.count = text, count
        self.chars, self.tokens = np.array(chars, "i8"), np.array(tokens, "i8")
        self.size = len(self.chars) // 2
        self.origin = np.concatenate([[0], np.cumsum(self.chars[self.size:])])
        self.changed: dict[int, str] = {}
        self.encoded = 0

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its start) that holds code point ``place``; the last
        non-empty one for the end of the text."""
        node, start = 1, 0
        place = min(place, max(int(self.chars[1]) - 1, 0))
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def leaf_text(self, leaf: int) -> str:
        got = self.changed.get(leaf)
        return self.text[self.origin[leaf]:self.origin[leaf + 1]] if got is None else got

    def put(self, leaf: int, text: str) -> None:
        self.changed[leaf] = text
        self.encoded += len(text)
        for tree, value in ((self.chars, len(text)), (self.tokens, self.count(text))):
            node = leaf + self.size
            change = value - tree[node]
            while node:
                tree[node] += change
                node //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace [start, end); everything right of ``end`` may have changed,
        nothing left of it has."""
        first, at = self.leaf_at(start)
        region, leaf, reach = self.leaf_text(first), first, at
        reach += len(region)
        while reach < end:
            leaf, more = self._next(leaf)
            region += more
            reach += len(more)
            self.put(leaf, "")
        region = region[:start - at] + new + region[end - at:]
        if region and region[-1] not in WHITE:
            following = self._next(first)
            if following is not None and following[1][0] not in WHITE:
                region += following[1]
                self.put(following[0], "")
        self.put(first, region)

    def _next(self, leaf: int):
        """(leaf, text) of the next non-empty leaf, or None."""
        node = leaf + self.size
        while node > 1:
            if node % 2 == 0 and self.chars[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.size:
            node = 2 * node if self.chars[2 * node] else 2 * node + 1
        return node - self.size, self.leaf_text(node - self.size)


def in_order(edits, length: int) -> list[tuple[int, int, str]]:
    """Edits that do not overlap, from left to right."""
    rows = sorted((e["start"], e["end"], e["replacement"] or "") for e in edits or []
                  if e is not None and e["start"] is not None and e["end"] is not None)
    out, reach = [], 0
    for start, end, new in rows:
        start = min(max(start, reach), length)
        end = min(max(end, start), length)
        out.append((start, end, new))
        reach = end
    return out


def edited(text: str, edits: list[tuple[int, int, str]]) -> str:
    parts, reach = [], 0
    for start, end, new in edits:
        parts += [text[reach:start], new]
        reach = end
    return "".join([*parts, text[reach:]])


def _build(path: str, names: list[str], text_at: int):
    def run(batches):
        enc = encoder(path)
        for batch in (part for whole in batches for part in row_slices(whole, text_at)):
            leaves, number = [], []
            for t in batch.column(text_at):
                own = _LEAVES.findall(t.as_py() or "")
                leaves += own
                number.append(len(own))
            sizes = [np.diff(starts) for _, _, starts in enc.encode(pa.array(leaves, pa.large_string()))]
            tokens = np.concatenate([np.empty(0, "i8"), *sizes])
            chars = np.fromiter(map(len, leaves), "i8", len(leaves))
            stop = np.cumsum(number)
            trees = [[heap(x[b - n:b]) for n, b in zip(number, stop)] for x in (chars, tokens)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(t, pa.list_(pa.int64())) for t in trees]], names=[*names, "chars", "tokens"])
    return run


def _apply(path: str):
    def run(batches):
        enc = encoder(path)
        remembered: dict[str, int] = {}

        def count(text: str) -> int:
            total = 0
            for chunk in re.split(f"[{WHITE}]+", text):
                if chunk:
                    n = remembered.get(chunk)
                    if n is None:
                        if len(remembered) > 100_000:
                            remembered.clear()
                        n = remembered[chunk] = len(enc.chunk(chunk))
                    total += n
            return total

        for batch in (part for whole in batches for part in row_slices(whole, 1)):
            out: list[tuple] = []
            for i in range(batch.num_rows):
                name, text, edits, chars, tokens = (batch.column(c)[i].as_py() for c in range(5))
                text = text or ""
                doc = Document(text, chars, tokens, count)
                todo = in_order(edits, len(text))
                for start, end, new in reversed(todo):
                    doc.edit(start, end, new)
                out.append((name, len(todo), tokens[1], int(doc.tokens[1]), int(doc.chars[1]), doc.encoded,
                            edited(text, todo), doc.chars, doc.tokens))
            kinds = [pa.int64()] * 6 + [pa.string()] + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)],
                names=["doc_id", "n_edits", "tokens_before", "tokens_after", "chars_after", "chars_encoded",
                       "new_text", "chars", "tokens"])
    return run


def build_trees(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, columns of ``keep``, chars, tokens)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *keep)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", " + TREE
    return rows.mapInArrow(_build(vocabulary or default_vocabulary(), rows.columns, 1), schema)


def apply_edits(trees: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """New texts, trees and counts of rows (doc_id, text, edits, chars, tokens)."""
    ship(trees.sparkSession)
    return (trees.select("doc_id", "text", F.col("edits").cast(EDITS).alias("edits"), "chars", "tokens")
                 .mapInArrow(_apply(vocabulary or default_vocabulary()), COUNTS))


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with the edits (doc_id, start, end, replacement) of each
    document; an edit of a document that is not there does nothing."""
    by = edits.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "replacement")).alias("edits"))
    return trees.join(by, "doc_id", "left")


def review_edits(text: Column, doc_id: Column) -> Column:
    """The edits of the registered query: e-mail addresses are masked, and
    three places that a hash of the doc_id chooses lose up to 24 code points
    and get a remark or nothing."""
    size = F.length(text).cast("bigint")
    masks = F.transform(find(text, EMAIL, F.contains(text, F.lit("@"))), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit("[email]").alias("replacement")))

    def place(i: int) -> Column:
        h = F.xxhash64(doc_id, F.lit(i))
        start = F.pmod(h, size + 1)
        return F.struct(start.alias("start"), (start + F.pmod(F.shiftright(h, 32), F.lit(25))).alias("end"),
                        F.when(F.pmod(F.shiftright(h, 16), F.lit(3)) == 0, "").otherwise(" (reviewed) ").alias("replacement"))

    return F.concat(masks, F.array(*[place(i) for i in range(3)])).cast(EDITS)


def edit_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Counts before and after ``review_edits`` of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "text", review_edits(text, F.col("doc_id")).alias("edits"))
    return apply_edits(build_trees(rows, vocabulary, keep=("edits",)), vocabulary)
