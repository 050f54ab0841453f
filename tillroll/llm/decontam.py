"""Operator 7: benchmark decontamination.

A copy is a local alignment (Smith-Waterman over words) of an item with a
document that reaches a share of the item's score; edits, insertions and
omissions lower the score.  The score bounds how many words of the item must
match, so of any set of its places that leaves out fewer, some must: these are
the item's seeds, its rarest words by counts of documents over the whole
corpus.  The score also bounds how many words of the document a copy spans.
Windows that hold the seeds and the words a copy needs are aligned, many at
once.  Both bounds hold for every copy, so none is missed.

The benchmark is the stated query set: it is taken in blocks of a bounded
size, each held against all documents.  A block's seeds go to the tasks, the
texts are never shuffled.

Defined results: NULL or empty texts, and items of fewer than LEAST words,
match nothing.  Of several copies of an item in a document the best is
reported, the first on ties.  Rows that repeat a document are each reported;
items that repeat are one.  NULL ids are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import lean, ship
from tillroll.llm.tokens import pieces, unsliced
from tillroll.llm.words import MARKS, word_hashes

#: Words of the shortest item.
LEAST = 3
#: Score of equal words; other pairs and gaps cost one.
MATCH = 2
#: A copy reaches this share of the score of the whole item, or the score of
#: this many equal words in a row.
SHARE, WORDS = 0.5, 20
#: Bytes of benchmark text taken at once.
BLOCK_BYTES = 16 << 20
MATCHES = "doc_id long, item_id long, score double, first_word long, last_word long"
#: Words in fewer than this share of the documents are seeds even where an item
#: needs fewer places; more of them must then match.  Changes the work only.
COMMON = 0.2
#: Bytes of text searched at once, as many where whole rows are held beside it,
#: and cells of windows held at once.
PIECE, BESIDE_ROWS, CELLS = 4 << 20, 1 << 20, 1 << 18
_FILTER = 1 << 20


@dataclass
class Items:
    """A block of test items; words are places in ``vocabulary``."""
    ids: list
    words: list[np.ndarray]
    vocabulary: np.ndarray       # word hashes, sorted
    need: np.ndarray = None      # seeds a window needs, by item
    first: np.ndarray = None     # of each word: where its items begin in ``held``
    held: np.ndarray = None      # items that have the word as a seed, word by word


def least_score(n: int) -> int:
    """The lowest score of a copy of an item of ``n`` words."""
    return int(np.ceil(MATCH * min(SHARE * n, WORDS)))


def least_words(n: int) -> int:
    """Words of an item that match in any copy."""
    return -(-least_score(n) // MATCH)


def longest(n: int) -> int:
    """Words of a document that a copy can span: every word between two that
    match costs one."""
    return (MATCH + 1) * n - least_score(n)


def _filter(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(_FILTER, bool)
    bits[(hashes & np.uint64(_FILTER - 1)).astype("i8")] = True
    return bits


def _words(texts: pa.Array):
    lower = pc.utf8_lower(unsliced(texts.cast(pa.large_string()).fill_null("")))
    return word_hashes(lower, MARKS)[:2]


def _places(texts: pa.Array, vocabulary: np.ndarray, bits: np.ndarray):
    """(place in the vocabulary of each word or -1, text starts)."""
    words, starts = _words(texts)
    out = np.full(len(words), -1, "i4")
    at = np.flatnonzero(bits[(words & np.uint64(_FILTER - 1)).astype("i8")])
    if len(vocabulary):
        place = np.minimum(np.searchsorted(vocabulary, words[at]), len(vocabulary) - 1)
        same = vocabulary[place] == words[at]
        out[at[same]] = place[same]
    return out, starts


def _count_documents(vocabulary: np.ndarray, piece: int = PIECE):
    """Documents that hold each word; all documents at place -1."""
    def run(batches):
        total, bits, n = np.zeros(len(vocabulary), "i8"), _filter(vocabulary), 0
        for batch in batches:
            n += batch.num_rows
            for _, texts in pieces(batch.column(0), piece):
                words, starts = _places(texts, vocabulary, bits)
                at = np.flatnonzero(words >= 0)
                text = np.searchsorted(starts, at, "right")
                both = np.unique(text * np.int64(len(vocabulary) + 1) + words[at])
                total += np.bincount(both % (len(vocabulary) + 1), minlength=len(vocabulary))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()),
                                          pa.array(np.append(total[at], n), pa.int64())], names=["word", "n"])
    return run


def choose_seeds(items: Items, documents: np.ndarray, total: int) -> None:
    """Each item's rarest places, and how many of them any copy holds: all but
    those that a copy may leave out."""
    items.need = np.zeros(len(items.words), "i8")
    pairs = []
    for item, words in enumerate(items.words):
        n = len(words)
        if n < LEAST:
            continue
        rarity = documents[words]
        spare = n - least_words(n)
        size = max(spare + 1, int((rarity <= COMMON * total).sum()))
        # Equal words all belong: the document's words are counted, not places.
        seeds = np.unique(words[np.argsort(rarity, kind="stable")[:size]])
        items.need[item] = size - spare
        pairs.append(np.stack([seeds, np.full(len(seeds), item)]))
    word, item = np.concatenate([np.empty((2, 0), "i8"), *pairs], axis=1)
    order = np.lexsort((item, word))
    items.held = item[order].astype("i8")
    items.first = np.searchsorted(word[order], np.arange(len(items.vocabulary) + 1))


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: (score, item end, words end) of the best alignment."""
    n = len(words)
    step = np.arange(1, n + 1)
    row = np.zeros(n + 1, "i8")
    best = (0, 0, 0)
    for i, w in enumerate(item):
        here = np.maximum(row[:-1] + np.where(words == w, MATCH, -1), row[1:] - 1)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + step) - step      # gaps along the row
        row = np.concatenate([row[:1], here])
        j = int(np.argmax(row))
        if row[j] > best[0]:
            best = (int(row[j]), i + 1, j)
    return best


def best_scores(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The best score of the item in each column of ``items`` with the words in
    that column of ``windows``; filled up with different negative numbers."""
    kind = "i2" if (MATCH + 1) * len(windows) < 1 << 15 else "i4"
    step = np.arange(1, len(windows) + 1, dtype=kind)[:, None]
    row = np.zeros((len(windows) + 1, windows.shape[1]), kind)
    best = np.zeros(windows.shape[1], kind)
    for w in items:
        here = np.maximum(row[:-1] + np.where(windows == w, np.array(MATCH, kind), np.array(-1, kind)), row[1:] - 1)
        np.maximum(here, 0, out=here)
        row[1:] = np.maximum.accumulate(here + step, axis=0) - step
        np.maximum(best, row.max(axis=0), out=best)
    return best


def score_bounds(gain: np.ndarray) -> np.ndarray:
    """The most that an alignment in each column can score: every word of the
    item inside it counts as a match, every other word costs one."""
    total = np.cumsum(gain, axis=0, dtype="i2" if MATCH * len(gain) < 1 << 15 else "i4")
    before = np.minimum.accumulate(np.concatenate([np.zeros_like(total[:1]), total[:-1]]), axis=0)
    return (total - before).max(axis=0)


def _windows(items: Items, words: np.ndarray, starts: np.ndarray):
    """(item, texts, first words) of the windows that have the seeds a copy
    needs.  Windows of an item are twice as long as a copy can be and begin at
    multiples of that, so that each copy lies in one."""
    size = items.first[words + 1] - items.first[words]
    at = np.flatnonzero((words >= 0) & (size > 0))
    size = size[at]
    text = np.searchsorted(starts, at, "right") - 1
    hit = np.repeat(np.arange(len(at)), size)
    item = items.held[np.arange(len(hit)) + np.repeat(items.first[words[at]] - (np.cumsum(size) - size), size)]
    order = np.argsort(item, kind="stable")       # by item, text and place
    hit, item = hit[order], item[order]
    text, at = text[hit], at[hit] - starts[text[hit]]
    span = np.array([longest(len(w)) for w in items.words], "i8")
    last = np.arange(len(item)) + items.need[item] - 1
    end = np.minimum(last, len(item) - 1)
    enough = (last < len(item)) & (item[end] == item) & (text[end] == text) & (at[end] - at < span[item])
    item, text, at = item[enough], text[enough], at[enough]
    window = at // span[item]
    n_texts, n_windows = len(starts), int(window.max(initial=0)) + 1
    key = (item * n_texts + text) * n_windows + window
    key = np.unique(np.concatenate([key, key - (window > 0)]))
    item, text, window = key // n_windows // n_texts, key // n_windows % n_texts, key % n_windows
    for i in np.unique(item):
        lo, hi = np.searchsorted(item, [i, i + 1])
        yield int(i), text[lo:hi], window[lo:hi] * span[i]


def _bounded(items: Items, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows (item, text, first word) of windows whose bound reaches a copy's
    score; a window that runs into the next text only gets a higher bound."""
    found = [np.empty((3, 0), "i8")]
    longer = np.concatenate([words, np.full(2 * max(map(longest, map(len, items.words)), default=0), -1, "i4")])
    gain = np.full(len(items.vocabulary) + 1, -1, "i1")       # place -1 is the last
    for item, text, first in _windows(items, words, starts):
        own = items.words[item]
        gain[own] = MATCH
        view = np.lib.stride_tricks.sliding_window_view(longer, 2 * longest(len(own)))
        chunk = max(1, CELLS // view.shape[1])
        for lo in range(0, len(text), chunk):
            t, f = text[lo:lo + chunk], first[lo:lo + chunk]
            some = score_bounds(np.ascontiguousarray(gain[view[starts[t] + f]].T)) >= least_score(len(own))
            found.append(np.stack([np.full(some.sum(), item), t[some], f[some]]))
        gain[own] = -1
    return np.concatenate(found, axis=1)


def _candidates(items: Items, words: np.ndarray, starts: np.ndarray):
    """(text, item, first word, end word) of windows with a copy."""
    item, text, first = _bounded(items, words, starts)
    size = np.array([len(w) for w in items.words], "i8")
    order = np.argsort(size[item], kind="stable")
    item, text, first = item[order], text[order], first[order]
    least = np.array([least_score(n) for n in size], "i8")
    out = []
    lo = 0
    while lo < len(item):
        hi = lo + 1                   # items of nearly the same length together
        while (hi < len(item) and size[item[hi]] <= size[item[lo]] * 5 // 4 + 4
               and (hi - lo + 1) * 2 * longest(size[item[hi]]) <= CELLS):
            hi += 1
        i, t, f = item[lo:hi], text[lo:hi], first[lo:hi]
        n = size[i[-1]]
        own = np.full((n, len(i)), -2, "i4")
        for k, x in enumerate(i):
            own[:size[x], k] = items.words[x]
        end = np.minimum(f + 2 * np.array([longest(x) for x in size[i]]), starts[t + 1] - starts[t])
        at = f + np.arange(2 * longest(n))[:, None]
        rows = np.where(at < end, words[np.minimum(starts[t] + at, len(words) - 1)], -1)
        for k in np.flatnonzero(best_scores(own, rows) >= least[i]):
            out.append((int(t[k]), int(i[k]), int(f[k]), int(end[k])))
        lo = hi
    return sorted(out)


def _best_copies(items: Items, texts: pa.Array, bits: np.ndarray, size: int = PIECE) -> dict:
    """(text, item) -> (score, first word, end word) of the best copy."""
    best: dict = {}
    for piece, some in pieces(texts, size):
        words, starts = _places(some, items.vocabulary, bits)
        for t, item, lo, hi in _candidates(items, words, starts):
            text, own = words[starts[t]:starts[t + 1]], items.words[item]
            score, i, j = align(own, text[lo:hi])
            if score > best.get((piece + t, item), (0,))[0]:
                _, _, back = align(own[:i][::-1], text[lo:lo + j][::-1])
                best[piece + t, item] = (score, lo + j - back, lo + j)
    return best


def _match(items: Items):
    def run(batches):
        bits = _filter(items.vocabulary)
        for batch in batches:
            best = _best_copies(items, batch.column(1), bits)
            ids = batch.column(0).to_pylist()
            out = [(ids[t], items.ids[item], s / (MATCH * len(items.words[item])), a, b)
                   for (t, item), (s, a, b) in sorted(best.items())]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)],
                names=["doc_id", "item_id", "score", "first_word", "last_word"])
    return run


def _read_items(rows) -> Items:
    words, starts = _words(pa.array([r["text"] for r in rows], pa.large_string()))
    vocabulary, places = np.unique(words, return_inverse=True)
    return Items([r["item_id"] for r in rows], [places[a:b] for a, b in zip(starts, starts[1:])], vocabulary)


def _item_blocks(texts: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, piece: int = PIECE,
                 task=lambda run: run):
    """Yield the test items block by block, their seeds chosen by ``texts``."""
    tests = benchmark.select(F.col(item_id).cast("long").alias("item_id"),
                             F.col(item_text).cast("string").alias("text")).where("text is not null").distinct()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        items = _read_items(sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"])))
        documents, total = np.zeros(len(items.vocabulary), "i8"), 0
        counts = texts.select("text").mapInArrow(task(_count_documents(items.vocabulary, piece)), "word long, n long")
        for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect():
            if r["word"] < 0:
                total = r["n"]
            else:
                documents[r["word"]] = r["n"]
        choose_seeds(items, documents, total)
        yield items


def benchmark_copies(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every copy found.

    ``score`` is the alignment's share of the whole item's score; the copy is
    words first_word .. last_word - 1 of the document, words being runs of
    letters and digits.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for items in _item_blocks(texts, benchmark, item_id, item_text):
        part = texts.mapInArrow(_match(items), MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def _drop_copies(items: Items, text_at: int):
    def run(batches):
        bits = _filter(items.vocabulary)
        for batch in batches:
            held = np.zeros(batch.num_rows, bool)
            held[[t for t, _ in _best_copies(items, batch.column(text_at), bits, BESIDE_ROWS)]] = True
            yield batch.filter(pa.array(~held))
    return run


def without_copies(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no copy of an item."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(text).cast("string").alias("text"))
    for items in _item_blocks(texts, benchmark, item_id, item_text, BESIDE_ROWS, lean):
        docs = docs.mapInArrow(lean(_drop_copies(items, docs.columns.index(text))), docs.schema)
    return docs
