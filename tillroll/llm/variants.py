"""Operator 11: spelling variants by a frequency-vector trie.

1. Runs of letters are counted per document, then over all documents (partial
   sums, so a frequent word costs a row per task).
2. A word's vector counts its letters in 16 groups.  Level i of the trie
   branches by the count in group i, and a word is a leaf below its vector.
   Vectors are 64-bit numbers of 4 bits a level, so a node is a range of
   numbers and is found in a sorted array.
3. An inserted, deleted or replaced letter changes a vector by a surplus of one
   in one group, a deficit of one in another, or neither.  A search goes down
   from the root, depth first in runs of nodes, and may spend one deficit and
   then one surplus; so of two near words just one finds the other.  (Words of
   one vector are compared once, in their order.  A group counts 15 at most:
   beyond, a change may not show, which only lets more words through.)  Leaf
   words are verified letter by letter.
4. The trie is dealt to tasks by its first levels, as many as the number of
   words asks for; a search goes to every subtrie that its budget reaches.  A
   subtrie of more than ``limit`` words is dealt by whole vectors instead, by a
   join that Spark can split where one vector has very many words.
5. A word has at most a few hundred near words per letter, which are summed up
   in aggregations.  Forms have ten times the count, so following them ends
   after as many steps as counts have digits; each round doubles the steps.

Defined results: NULL and empty texts have no words; repeated rows count each;
a NULL doc_id has no number to distort a run by, so its runs stay whole; words
of equal count are taken in code-point order; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import by_size, cut, ship
from tillroll.llm.tokens import pieces

LEVELS, WIDTH = 16, 4
MOST = (1 << WIDTH) - 1
#: One group per frequent letter, the others by turns.
ALONE = "eaionrstludcmp"
#: Words of a subtrie that goes to one task, and per subtrie on average.
LIMIT, SUBTRIE = 1 << 16, 1 << 14
#: Searches taken up at once; words of a leaf that are all compared.
SEARCHES, LARGE_LEAF = 1 << 12, 256
#: Distinct words counted by a task at once.
COUNTED = 1 << 17


def letter_group(c: str) -> int:
    at = ALONE.find(c)
    return at if at >= 0 else len(ALONE) + ord(c) % (LEVELS - len(ALONE))


_GROUP = {chr(c): letter_group(chr(c)) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]}


def vector(word: str) -> int:
    """Counts of the word's letters by group, the first group highest."""
    counts = [0] * LEVELS
    for c in word:
        counts[_GROUP[c] if c in _GROUP else letter_group(c)] += 1
    out = 0
    for n in counts:
        out = out << WIDTH | min(n, MOST)
    return out


def near(x: str, y: str) -> bool:
    """Whether just one inserted, deleted or replaced code point parts them."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > 1 or x == y:
        return False
    i, n = 0, len(y)
    while i < n and x[i] == y[i]:
        i += 1
    return x[i + 1:] == (y[i + 1:] if len(x) == n else y[i:])


# -- words

def distorted(doc_id: int | None, run: str) -> str:
    """The run, or for one in 31 of a document's different runs, without one letter."""
    if doc_id is None:
        return run
    h = zlib.crc32(run.encode(), zlib.crc32(b"%d:" % doc_id))
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _words(letters: int, alter: Callable | None):
    # A shorter run cannot become long enough.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % letters)

    def run(batches):
        total: dict[str, int] = {}

        def flush():
            names = list(total)
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([total[w] for w in names], pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for at, texts in pieces(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                for doc_id, text in zip(ids, texts):
                    # Lowered as bytes, which changes ASCII alone.
                    lower = text.as_buffer().to_pybytes().lower().decode()
                    for word, n in Counter(runs.findall(lower)).items():
                        if alter is not None:
                            word = alter(doc_id, word)
                            if len(word) < letters:
                                continue
                        total[word] = total.get(word, 0) + n
                if len(total) > COUNTED:
                    yield flush()
        yield flush()
    return run


def count_words(docs: DataFrame, letters: int = 7, least: int = 2, alter: Callable | None = None,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of ``letters`` code points that occur ``least`` times."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return (rows.mapInArrow(_words(letters, alter), "word string, n long")
                .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


# -- the trie

def reached(code: int, depth: int, start: int = 0, prefix: int = 0, spent: int = 0) -> list[tuple[int, int]]:
    """(prefix, spent) of the nodes at ``depth`` that a search for ``code`` can
    reach from the node ``prefix`` of ``start`` levels.

    ``spent``: 0 nothing, 1 the deficit, 2 both.  Counts are not negative, and a
    surplus in a full group does not show.
    """
    levels = range(start, depth)
    counts = {i: code >> WIDTH * (LEVELS - 1 - i) & MOST for i in levels}
    unit = {i: 1 << WIDTH * (depth - 1 - i) for i in levels}
    own = prefix << WIDTH * (depth - start)
    own += code >> WIDTH * (LEVELS - depth) & (1 << WIDTH * (depth - start)) - 1
    out = [(own, spent)]
    if spent == 1:
        out += [(own + unit[j], 2) for j in levels if counts[j] < MOST]
    for i in levels if spent == 0 else ():
        if counts[i]:
            less = own - unit[i]
            out.append((less, 1))
            out += [(less + unit[j], 2) for j in range(i + 1, depth) if counts[j] < MOST]
    return out


def search(codes: np.ndarray, query: np.ndarray, spent: np.ndarray, prefix: np.ndarray, depth: int):
    """(query, leaf) places of the leaves that searches reach.

    ``codes``: the sorted different vectors of a part of the trie.  Search i has
    the vector query[i], stands at the node prefix[i] of ``depth`` levels and
    has spent that much of its budget.
    """
    found = []
    for at in range(0, len(query), SEARCHES):
        which = np.arange(at, min(at + SEARCHES, len(query)))
        node = prefix[which] << np.uint64(WIDTH * (LEVELS - depth)) if depth else np.zeros(len(which), "u8")
        state = spent[which]
        waiting = [(depth, which, node, state)]
        while waiting:
            level, which, node, state = waiting.pop()
            if level == LEVELS:
                at_leaf = np.searchsorted(codes, node)
                there = np.append(codes, np.uint64(0))[at_leaf] == node
                there &= at_leaf < len(codes)
                found.append((which[there], at_leaf[there]))
                continue
            shift = np.uint64(WIDTH * (LEVELS - 1 - level))
            count = (query[which] >> shift) & np.uint64(MOST)
            less, more = (state == 0) & (count > 0), (state == 1) & (count < MOST)
            which, node, count, state = (
                np.concatenate([which, which[less], which[more]]), np.concatenate([node, node[less], node[more]]),
                np.concatenate([count, count[less] - np.uint64(1), count[more] + np.uint64(1)]),
                np.concatenate([state, state[less] + 1, state[more] + 1]))
            node = node | (count << shift)
            low = np.searchsorted(codes, node)
            last = node | ((np.uint64(1) << shift) - np.uint64(1))
            there = np.searchsorted(codes, last, "right") > low
            which, node, state = which[there], node[there], state[there]
            for i in range(0, len(which), 8 * SEARCHES):
                part = slice(i, i + 8 * SEARCHES)
                waiting.append((level + 1, which[part], node[part], state[part]))
    if not found:
        return np.empty(0, "i8"), np.empty(0, "i8")
    return tuple(np.concatenate(x) for x in zip(*found))


ROWS = "key long, spent int, word string, n long, code long"
PAIRS = "word string, other string, other_n long"


def _deal(depth: int):
    """Each word to its own subtrie, as a leaf (spent: NULL), and to those that
    its search reaches."""
    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for i, word in enumerate(batch.column(0).to_pylist()):
                code = vector(word)
                for key, spent in [(code >> WIDTH * (LEVELS - depth), None), *reached(code, depth)]:
                    for col, x in zip(out, (key, spent, i, code)):
                        col.append(x)
            key, spent, row, code = out
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(key, "u8").view("i8")), pa.array(spent, pa.int32()), batch.column(0).take(row),
                 batch.column(1).take(row), pa.array(np.array(code, "u8").view("i8"))],
                names=["key", "spent", "word", "n", "code"])
    return run


def _with_one_less(word: str) -> list[str]:
    return [word[:i] + word[i + 1:] for i in range(len(word))]


class Leaf:
    """The words of one vector; a large leaf finds them by what is left of a
    word without one letter, so that not all of them are compared."""

    def __init__(self, rows: list[int], words: list[str]):
        self.rows, self.index = rows, None
        if len(rows) > LARGE_LEAF:
            self.index = {}
            for r in rows:
                for part in {words[r], *_with_one_less(words[r])}:
                    self.index.setdefault(part, []).append(r)

    def candidates(self, word: str):
        if self.index is None:
            return self.rows
        return {r for part in _with_one_less(word) for r in self.index.get(part, ())}


def _subtrie_pairs(depth: int):
    """Near words, both ways, of whole subtries that follow each other."""
    def pairs(rows: pa.Table):
        rows = rows.combine_chunks()
        spent = rows.column("spent").combine_chunks()
        key, code = (rows.column(c).to_numpy().view("u8") for c in ("key", "code"))
        leaf = spent.is_null().to_numpy(zero_copy_only=False)
        words, ns = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        leaves = np.flatnonzero(leaf)
        leaves = leaves[np.argsort(code[leaves], kind="stable")]
        codes, first = np.unique(code[leaves], return_index=True)
        first = np.append(first, len(leaves))
        asks = np.flatnonzero(~leaf)
        known: dict[int, Leaf] = {}
        for at in range(0, len(asks), SEARCHES):
            some = asks[at:at + SEARCHES]
            state = spent.take(pa.array(some)).to_numpy()
            who, where = search(codes, code[some], state, key[some], depth)
            out: list[list] = [[], [], []]
            for q, at_leaf in zip(some[who].tolist(), where.tolist()):
                if at_leaf not in known:
                    known[at_leaf] = Leaf(leaves[first[at_leaf]:first[at_leaf + 1]].tolist(), words)
                x, same = words[q], code[q] == codes[at_leaf]
                for other in known[at_leaf].candidates(x):
                    y = words[other]
                    if (not same or x < y) and near(x, y):
                        for col, v in zip(out, ((x, y), (y, x), (int(ns[other]), int(ns[q])))):
                            col += v
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                names=["word", "other", "other_n"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 2 * LIMIT:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))      # the last subtrie may go on
            if whole:
                yield from pairs(table.slice(0, whole))
            held = table.slice(whole).to_batches()
            rows = len(key) - whole
        if rows:
            yield from pairs(pa.Table.from_batches(held))
    return run


def _whole_vectors(depth: int):
    """Where the searches of large subtries end: one row per vector reached."""
    def run(batches):
        for batch in batches:
            row, leaf = [], []
            key, code = (batch.column(c).to_numpy().view("u8").tolist() for c in ("key", "code"))
            for i, spent in enumerate(batch.column("spent").to_pylist()):
                for whole, _ in reached(code[i], LEVELS, depth, key[i], spent):
                    row.append(i)
                    leaf.append(whole)
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(leaf, "u8").view("i8")), *[batch.column(c).take(row) for c in ("word", "n", "code")]],
                names=["leaf", "x", "x_n", "x_code"])
    return run


def _by_vector(rows: DataFrame, depth: int) -> DataFrame:
    """Near words of subtries that are dealt by whole vectors."""
    asks = rows.where("spent is not null").mapInArrow(_whole_vectors(depth), "leaf long, x string, x_n long, x_code long")
    leaves = rows.where("spent is null").select(F.col("code").alias("leaf"), F.col("word").alias("y"), F.col("n").alias("y_n"))
    both = asks.join(leaves, "leaf").where((F.col("x_code") != F.col("leaf")) | (F.col("x") < F.col("y")))
    both = both.where(F.levenshtein("x", "y", 1) == 1)
    return both.select(F.inline(F.array(
        F.struct(F.col("x").alias("word"), F.col("y").alias("other"), F.col("y_n").alias("other_n")),
        F.struct(F.col("y").alias("word"), F.col("x").alias("other"), F.col("x_n").alias("other_n")))))


def near_words(words: DataFrame, limit: int = LIMIT, depth: int | None = None) -> DataFrame:
    """(word, other, other_n) of all near pairs, each both ways, of the
    different ``words`` (word, n)."""
    spark = words.sparkSession
    ship(spark)
    if depth is None:
        # A level of the first ones, one letter each, halves a subtrie at least.
        depth = min(LEVELS, max(0, (words.count() // SUBTRIE).bit_length()))
    rows = cut(words.select("word", "n").mapInArrow(_deal(depth), ROWS), "subtries")
    sizes = rows.where("spent is null").groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    large = cut(sizes.where(F.col("size") > limit).select("key"), "large-subtries")
    if large.isEmpty():
        return _by_subtrie(rows, depth)
    return (_by_subtrie(rows.join(large, "key", "left_anti"), depth)
            .unionByName(_by_vector(rows.join(large, "key", "left_semi"), depth)))


def _by_subtrie(rows: DataFrame, depth: int) -> DataFrame:
    return (rows.repartition(by_size(rows.sparkSession), "key").sortWithinPartitions("key")
                .mapInArrow(_subtrie_pairs(depth), PAIRS))


def _last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last, twice as far each round."""
    at = cut(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("goes_on")), "roots")
    while not at.where("goes_on").isEmpty():
        next_ = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = cut(at.join(next_, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("goes_on")), "roots")
    return at.select("word", "root")


def variants(words: DataFrame, times: int = 10, limit: int = LIMIT, depth: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the different ``words`` (word, n).

    The form is the most frequent near word, ties to the smallest, if it is
    ``times`` as frequent; the root is where forms lead.
    """
    words = cut(words.select("word", "n"), "words")
    best = (near_words(words, limit, depth).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))
    named = words.join(best, "word", "left")
    form = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.other"))
    named = cut(named.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"),
                             F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "forms")
    roots = _last_forms(named.where(F.col("form").isNotNull()))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
