"""Operator 13: periodic run detection by online dyadic square catching.

A run is a maximal stretch of words with smallest period q (words q apart are
equal), of at least ``least`` words and at least ``times`` periods.

``SquareCatcher`` reads words as they are appended.

1. Every completed block of 2^k words, on a grid, has a catcher.  It waits for
   the block to occur again q words later, for the q of its level only: a run
   of period q holds a whole block of that size together with its copy, so
   each run is caught.  Each appended word ends one window per level, which is
   compared with the one or two blocks that wait for it, by prefix hashes.
2. A catch starts a suffix comparison at lag q: backwards to the stretch's
   first word, forwards over the words there are.  A comparison that reaches
   the last word stays open and goes on with the next words appended.
   Comparisons are of the words' numbers, so a clash of hashes only costs time.
3. Squares of one lag and stretch are one comparison, and so merge into one
   run.  Catches inside a stretch of a period of at most the block's size are
   multiples of that period and are passed over.

A level costs a few numpy operations per appended word and the levels are as
many as the logarithm of the longest document, so the work is about n log n.
Documents are cut into words in runs of 3 MB of text; short ones follow each
other in one catcher, parted by numbers that occur once, and a long one is
appended in pieces.

Spark maps over the documents; nothing is shuffled, so a hot key or source has
no effect, and a lost executor's tasks are simply run again.

Defined results: NULL and blank texts have no words and no runs; repeated rows
are each answered; a NULL doc_id has no number to alter words by, so its words
stay as they are; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import ship
from tillroll.llm.tokens import pieces
from tillroll.llm.words import mix

#: Words appended at once.
PIECE = 1 << 16
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
SCHEMA = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
_X = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(int(_X), -1, 1 << 64))


class SquareCatcher:
    """Finds the runs of a sequence of integers that is appended bit by bit."""

    def __init__(self, least: int = 24, times: int = 3):
        if times < 2:
            raise ValueError("a run has two periods at least")
        self.least, self.times = least, times
        # Words of a run that have an equal word one period on, at least.
        whole = min(max(least, times * q) - q for q in range(1, max(2, least + 1)))
        self.base = 1 << ((whole + 1) // 2).bit_length() - 1
        # A block waits for windows this many cells of the grid on.
        self.cells = (1,) if times >= 3 else (2, 3)
        self.n = 0
        self._words = np.empty(PIECE, "i8")
        self._sum = np.zeros(PIECE + 1, "u8")       # prefix sums of word * X^place
        self._power = np.ones(PIECE + 1, "u8")
        self._back = np.ones(PIECE + 1, "u8")       # X^-place
        self._next: dict[int, int] = {}             # level -> first window not yet seen
        self._open: dict[int, int] = {}             # lag -> start of the stretch that reaches the end
        self._last: dict[int, tuple[int, int]] = {}  # lag -> its latest stretch
        self._runs: list[tuple[int, int, int]] = []  # start, end, period

    # -- the sequence and its hashes
    def _grow(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self._words):
            size = max(self.n, 2 * len(self._words))
            self._words = np.resize(self._words, size)
            for name in ("_sum", "_power", "_back"):
                setattr(self, name, np.resize(getattr(self, name), size + 1))
        new = slice(old + 1, self.n + 1)
        self._words[old:self.n] = words
        for array, factor in ((self._power, _X), (self._back, _UNDO)):
            array[new] = factor
            np.cumprod(array[old:self.n + 1], out=array[old:self.n + 1])
        terms = mix(words.astype("u8")) * self._power[old:self.n]
        self._sum[new] = self._sum[old] + np.cumsum(terms, dtype="u8")

    def _hashes(self, first: int, last: int, size: int, step: int = 1) -> np.ndarray:
        """Of the windows of ``size`` words that begin at range(first, last, step)."""
        return ((self._sum[first + size:last + size:step] - self._sum[first:last:step])
                * self._back[first:last:step])

    # -- suffix comparisons
    def _backward(self, at: int, lag: int) -> int:
        step, w = 64, self._words
        while at > 0:
            low = max(0, at - step)
            unequal = np.flatnonzero(w[low:at] != w[low + lag:at + lag])
            if len(unequal):
                return low + int(unequal[-1]) + 1
            at, step = low, min(2 * step, PIECE)
        return at

    def _forward(self, at: int, lag: int) -> int:
        """First place from ``at`` on that differs from the word ``lag`` on."""
        step, w, stop = 64, self._words, self.n - lag
        while at < stop:
            high = min(stop, at + step)
            unequal = np.flatnonzero(w[at:high] != w[at + lag:high + lag])
            if len(unequal):
                return at + int(unequal[0])
            at, step = high, min(2 * step, PIECE)
        return at

    def _settle(self, start: int, stop: int, lag: int) -> None:
        """Keep the stretch open if it reaches the end, else report its run."""
        self._last[lag] = (start, stop)
        if stop + lag >= self.n:
            self._open[lag] = start
        else:
            self._report(start, stop, lag)

    def _report(self, start: int, stop: int, lag: int) -> None:
        if stop - start + lag >= max(self.least, self.times * lag):
            self._runs.append((start, stop + lag, lag))

    # -- catching
    def _covered(self, s: np.ndarray, block: int) -> np.ndarray:
        """Per block start, the furthest end of a stretch around it with a
        period of at most ``block``."""
        low, out = int(s.min()), np.zeros(int(s.max() - s.min()) // block + 1, "i8")
        known = [(a, self.n) for q, a in self._open.items() if q <= block]
        known += [(a, z) for a, z, q in self._runs if q <= block and z > low]
        for a, z in known:
            part = out[max(0, -(-(a - low) // block)):max(0, (z - low) // block + 1)]
            np.maximum(part, z, out=part)
        return out[(s - low) // block]

    def _catch(self, s: np.ndarray, lag: np.ndarray, block: int) -> None:
        """Follow the catches of one level; blocks start at s, sorted by lag, s."""
        keep = self._covered(s, block) < s + lag + block
        s, lag = s[keep], lag[keep]
        if not len(s):
            return
        first = np.ones(len(s), bool)       # of neighbouring blocks at one lag
        first[1:] = (lag[1:] != lag[:-1]) | (s[1:] - s[:-1] != block)
        for at, q in zip(s[first].tolist(), lag[first].tolist()):
            start, stop = self._last.get(q, (0, 0))
            if q in self._open and at >= start or start <= at and at + block <= stop:
                continue
            stop = self._forward(at, q)
            if stop >= at + block:
                self._settle(self._backward(at, q), stop, q)

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Go on with ``words``.  No run reaches over more than ``longest``
        words (by default, over all there are so far)."""
        self._grow(words)
        going, self._open = self._open, {}
        for lag, start in going.items():
            self._settle(start, self._forward(self._last[lag][1], lag), lag)
        longest = self.n if longest is None else longest
        block = self.base
        while block == self.base or self.times * self.cells[0] * block <= longest:
            low, high = self._next.get(block, 0), self.n - block + 1
            if low < high:
                self._next[block] = high
                self._level(block, low, high)
            block *= 2

    def _level(self, block: int, low: int, high: int) -> None:
        windows = self._hashes(low, high, block)
        at = np.arange(low, high)
        cell = at // block
        cells = range(self.cells[-1] + 1) if block == self.base else self.cells
        begin = max(0, int(cell[0]) - self.cells[-1])
        blocks = self._hashes(begin * block, int(cell[-1]) * block + 1, block, block)
        starts, lags = [], []
        for d in cells:
            of = cell - d
            found = np.flatnonzero((of >= begin) & (of * block < at) & (blocks[np.maximum(of - begin, 0)] == windows))
            starts.append(of[found] * block)
            lags.append(at[found] - of[found] * block)
        s, lag = np.concatenate(starts), np.concatenate(lags)
        if not len(s):
            return
        order = np.lexsort((s, lag))
        s, lag = s[order], lag[order]
        if block > self.base:
            return self._catch(s, lag, block)
        # Of the lags of the smallest blocks, one may be a multiple of another.
        edge = [0, *(np.flatnonzero(np.diff(lag)) + 1).tolist(), len(s)]
        for i, j in zip(edge, edge[1:]):
            self._catch(s[i:j], lag[i:j], block)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs of all that was appended, sorted."""
        for lag, start in self._open.items():
            self._report(start, self._last[lag][1], lag)
        self._open = {}
        best: dict[tuple[int, int], int] = {}
        for a, z, q in self._runs:
            best[a, z] = min(q, best.get((a, z), q))
        return sorted((a, z - a, q) for (a, z), q in best.items())


def _runs_of(words: np.ndarray, starts: np.ndarray, least: int, times: int) -> list[list]:
    """Runs of each document; document d is words[starts[d]:starts[d + 1]]."""
    size = np.diff(starts)
    out: list[list] = [[] for _ in size]
    d = 0
    while d < len(size):
        to = max(d + 1, int(np.searchsorted(starts, starts[d] + PIECE, "right")) - 1)
        some = words[starts[d]:starts[to]]
        if size[d:to].max(initial=0) >= least:
            catcher = SquareCatcher(least, times)
            if to == d + 1:
                for at in range(0, len(some), PIECE):
                    catcher.append(some[at:at + PIECE])
                first = np.zeros(1, "i8")
            else:
                # A number of its own after each document.
                first = starts[d:to] - starts[d] + np.arange(to - d)
                joined = np.empty(len(some) + to - d, "i8")
                joined[first + size[d:to]] = -1 - np.arange(to - d)
                joined[np.arange(len(some)) + np.repeat(np.arange(to - d), size[d:to])] = some
                catcher.append(joined, int(size[d:to].max()))
            for a, length, q in catcher.runs():
                of = int(np.searchsorted(first, a, "right")) - 1
                out[d + of].append((a - int(first[of]), length, q))
        d = to
    return out


def echoed(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) if the words from ``a`` on repeat the p words there: a tenth of
    the documents, by the checksum of their id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or n == 0 or h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _document_runs(least: int, times: int, alter: Callable | None):
    def rows(ids: list, texts: pa.Array) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten()
        real = pc.binary_length(flat).to_numpy() > 0
        ends = split.offsets.to_numpy().astype("i8")
        starts = np.concatenate([[0], np.cumsum(real)])[ends - ends[0]]
        flat = flat.filter(pa.array(real))
        source = np.arange(len(flat))
        if alter is not None:
            for d, name in enumerate(ids):
                lo, hi = int(starts[d]), int(starts[d + 1])
                echo = alter(name, hi - lo)
                if echo is not None:
                    a, p = echo
                    source[lo + a:hi] = lo + a + np.arange(hi - lo - a) % p
        words = flat.dictionary_encode().indices.to_numpy().astype("i8")[source]
        found = _runs_of(words, starts, least, times)
        kept = np.ones(len(source), bool)
        for d, runs in enumerate(found):
            for a, length, q in runs:
                kept[starts[d] + a + q:starts[d] + a + length] = False
        left = np.concatenate([[0], np.cumsum(kept)])[starts]
        lists = pa.LargeListArray.from_arrays(pa.array(left), flat.take(pa.array(source[kept])))
        table = [r for runs in found for r in runs]
        at = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype("i4")
        fields = [pa.array([r[i] for r in table], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.diff(starts)),
             pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
             pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            for at, texts in pieces(batch.column(1)):
                yield rows(batch.column(0).slice(at, len(texts)).to_pylist(), texts)
    return run


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, alter: Callable | None = None,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document.

    ``runs`` are (start, length, period) in words, by start, then period;
    ``collapsed`` is the text without the words that any run holds after its
    first period, the rest joined by single blanks.  ``alter(doc_id, n)`` may
    name a place and a period to repeat the words from there by beforehand.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_document_runs(least, times, alter), SCHEMA)


def _better(x: Column, y: Column) -> Column:
    """The run of the two with the greater length / period; the first if equal."""
    return F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x)


def digest(found: DataFrame) -> DataFrame:
    """The result of ``periodic_runs`` in numbers and checksums."""
    runs = F.col("runs")
    top = F.when(F.size(runs) > 0, F.reduce(runs, F.element_at(runs, 1), _better))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("top", top).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")))
