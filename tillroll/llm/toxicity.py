"""Operator 9: toxicity by a subsequence string-kernel support vector machine.

The kernel of two words counts common subsequences of four symbols that span at
most six, each weighted by GAP to the number of skipped places, so inserted and
missing letters weaken a match instead of ending it; it is normalised and taken
to the power DEGREE.  The symbols are letters and the word's ends: marks and
digits inside a word are skipped, accents dropped, and words spelt letter by
letter put together.

Training takes a bounded, documented sample: up to SAMPLE toxic and CLEAN times
as many other labelled documents by hash order, one of each set of near copies,
cut into sentences.  Words of any length are toxic whose toxic documents are
more than chance deals out (Benjamini-Hochberg over all words), so no language
needs a share of the labels.  Those of them that no other stands for, and frequent
other words, are the Nystroem landmarks; sentences that hold the former are the toxic ones (a
toxic document need not have only toxic sentences) and give the word nearest to
a landmark, clean sentences give all theirs that come near one.  A linear SVM is
trained on the landmark features.

A document's margin is the highest of all its words'; a word whose kernel with
every landmark is below FLOOR counts as none.  A logistic curve fitted on the
sampled documents turns margins into scores.  Workers remember the margins of
words, up to REMEMBERED of them.

Defined results: NULL and empty texts get the score of a text without any
match.  Repeated rows are scored alike; of several labels of a document the
highest counts, NULL labels none.  With one class of label only, every score
is that class's share.  NULL doc_ids are not held out.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import give_back, lean, map_large_blocks, ship
from tillroll.llm.spans import let
from tillroll.llm.tokens import pieces

#: Sampled documents of a class, sentences of a class that reach the driver, the
#: length at which sentences are cut, and landmarks of each kind.
SAMPLE, SENTENCES, SENTENCE_CHARS, LANDMARKS = 1500, 6000, 240, 160
#: Clean documents sampled for each toxic one, toxic words that reach the driver,
#: their least documents and share of false ones, and the kernel at which a landmark
#: stands for a word.
CLEAN, TOXIC_WORDS, LEAST, FALSE_SHARE, STANDS = 4, 2000, 4, 0.5, 0.75
GAP, SPAN, DEGREE, FLOOR = 0.85, 6, 2, 0.4
#: Forms of a toxic word with a letter put in that train the machine and its curve, and
#: what distorted words count beside whole documents in the curve.
INSERTED, DISTORTED = 3, 0.5
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: Symbols: nothing, 26 letters and the end of a word.
_CODES = 28
_END = 27
OFFSETS = [(0, *c) for c in combinations(range(1, SPAN), 3)]
#: Bytes of text scored at once, words whose features are held at once, and
#: words whose margins a worker remembers.
PIECE, AT_ONCE, REMEMBERED = 2 << 20, 5_000, 250_000

_LETTER = np.full(256, -1, "i1")                  # dropped
_LETTER[65:91] = _LETTER[97:123] = np.arange(1, 27)
#: The base letters of the second bytes of Latin-1 letters.
_BASE = dict(zip(range(0xA0, 0xC0), "aaaaaaaceeeeiiiidnooooo ouuuuyty"))

_ACCENTED = np.full(256, -1, "i1")
for _byte, _base in _BASE.items():
    if _base != " ":
        _ACCENTED[_byte] = _ACCENTED[_byte - 32] = ord(_base) - 96
_ACCENTED[0x9F] = 19                               # a sharp s


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def stream(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words, _END on both sides of each and SPAN zeros between
    them, and the word each place belongs to."""
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), "u1")
    codes = _LETTER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    codes[latin] = _ACCENTED[data[latin]]
    word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])[codes >= 0]
    codes = codes[codes >= 0]
    size = np.bincount(word, minlength=len(raw))
    starts = np.cumsum(size + 2 + SPAN) - (size + 2 + SPAN)
    out = np.zeros(int((size + 2 + SPAN).sum()) + SPAN, "i4")
    out[starts] = out[starts + size + 1] = _END
    out[np.arange(len(codes)) + np.repeat(starts + 1 - (np.cumsum(size) - size), size)] = codes
    return out, np.repeat(np.arange(len(raw)), size + 2 + SPAN)


def subsequences(codes: np.ndarray):
    """(index, weight) per set of offsets: index[i] names the four letters from
    place i on."""
    n = len(codes) - SPAN
    parts = [codes * _CODES ** (3 - k) for k in range(4)]
    for at in OFFSETS:
        yield sum(parts[k][o:o + n] for k, o in enumerate(at)), GAP ** (at[-1] - 3)


def all_set() -> np.ndarray:
    """Which indices of a table of subsequences name four symbols."""
    i = np.arange(_CODES ** 4)
    return np.all([i // _CODES ** k % _CODES > 0 for k in range(4)], axis=0)


_FULL = None


def _entries(words: list[str]):
    """(word, subsequence, weight) of everything the words hold."""
    global _FULL
    if _FULL is None:
        _FULL = all_set()
    codes, owner = stream(words)
    found = []
    for index, weight in subsequences(codes):
        at = np.flatnonzero(_FULL[index])
        found.append((owner[at], index[at], np.full(len(at), weight, "f4")))
    return [np.concatenate(x) for x in zip(*found)]


def _summed(word, index, weight):
    """The same with one entry per word and subsequence."""
    key = word * np.int64(_CODES ** 4) + index
    key, inverse = np.unique(key, return_inverse=True)
    return key // _CODES ** 4, key % _CODES ** 4, np.bincount(inverse, weights=weight, minlength=len(key))


def landmark_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of each subsequence or -1, matrix of subsequences x words with
    columns of length one)."""
    word, index, weight = _summed(*_entries(words))
    used, row = np.unique(index, return_inverse=True)
    place = np.full(_CODES ** 4, -1, "i4")
    place[used] = np.arange(len(used))
    matrix = np.zeros((len(used), len(words)))
    matrix[row, word] = weight
    return place, (matrix / np.maximum(np.sqrt((matrix ** 2).sum(axis=0)), 1e-12)).astype("f4")


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 30):
    """Linear SVM with squared hinge and classes of equal weight, by Newton's
    method; returns weights and bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    cost = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)) * len(y) / 2 * c
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        a = x[inside] * cost[inside][:, None]
        new = np.linalg.solve(a.T @ x[inside] + ridge, a.T @ y[inside])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], w[-1]


@dataclass
class Model:
    place: np.ndarray            # of every subsequence in ``matrix``, or -1
    matrix: np.ndarray           # subsequences x landmarks
    beta: np.ndarray             # the machine's weight of each landmark
    bias: float
    slope: float
    shift: float
    landmarks: list[str]
    n_toxic: int = 0             # landmarks that come from toxic documents
    distorted: np.ndarray | None = None      # margins of distorted words, while training

    def __post_init__(self):
        self.most = np.zeros(len(self.place), "f4")
        if self.matrix.size:
            most = self.matrix[:, :self.n_toxic].max(axis=1)
            self.most[self.place >= 0] = most[self.place[self.place >= 0]]

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(places of the words near a toxic landmark, their kernels)."""
        places, rows = [np.empty(0, "i8")], [np.empty((0, len(self.landmarks)), "f4")]
        if not self.matrix.size:
            return places[0], rows[0]
        for lo in range(0, len(words), AT_ONCE):
            n = len(words[lo:lo + AT_ONCE])
            word, index, weight = _entries(words[lo:lo + AT_ONCE])
            # Repeated subsequences only add to a word's length: this bounds
            # its kernel with any landmark from above.
            length = np.sqrt(np.bincount(word, weights=weight * weight, minlength=n))
            bound = np.bincount(word, weights=weight * self.most[index], minlength=n)
            some = bound >= FLOOR * np.maximum(length, 1e-9)
            kept = some[word]
            word, index, weight = _summed(word[kept], index[kept], weight[kept])
            length = np.sqrt(np.bincount(word, weights=weight * weight, minlength=n))
            at = self.place[index]
            word, weight, at = word[at >= 0], weight[at >= 0], at[at >= 0]
            if not len(word):
                continue
            first = np.flatnonzero(np.diff(word, prepend=-1))
            kernel = np.add.reduceat(self.matrix[at] * weight[:, None].astype("f4"), first, axis=0)
            kernel /= length[word[first], None].astype("f4")
            good = kernel[:, :self.n_toxic].max(axis=1) >= FLOOR
            places.append(lo + word[first][good])
            rows.append(kernel[good])
        return np.concatenate(places), np.concatenate(rows)

    def word_margins(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        at, rows = self.near(words)
        out[at] = np.maximum(rows.astype("f8") ** DEGREE @ self.beta, 0)
        return out + self.bias

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Highest word of each text; the bias alone where none is near."""
        out = np.full(len(texts), self.bias)
        if self.matrix.size:
            for at, some in pieces(texts, PIECE):
                out[at:at + len(some)] = np.maximum(out[at:at + len(some)], self._margins(some))
        return out

    def _margins(self, texts: pa.Array) -> np.ndarray:
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        ends, words = split.offsets.to_numpy().astype("i8"), split.flatten()
        ends -= ends[0]
        value = np.concatenate([self._remembered(words), [-np.inf]])
        best = np.maximum.reduceat(value, np.minimum(ends[:-1], len(words)))
        best[np.diff(ends) == 0] = -np.inf
        # Three or more single letters in a row are read as one word.
        single = pc.equal(pc.binary_length(words), 1).to_numpy(zero_copy_only=False)
        inner = np.zeros(len(words), bool)
        inner[ends[1:-1][ends[1:-1] < len(words)]] = True       # a text begins
        run = np.flatnonzero(single & ~(np.concatenate([[False], single[:-1]]) & ~inner))
        if len(run):
            stop = np.flatnonzero(single & ~(np.concatenate([single[1:], [False]]) & ~np.concatenate([inner[1:], [True]]))) + 1
            long = stop - run >= 3
            spelt = ["".join(words.slice(a, b - a).to_pylist()) for a, b in zip(run[long], stop[long])]
            if spelt:
                text = np.searchsorted(ends, run[long], "right") - 1
                np.maximum.at(best, text, self.word_margins(spelt))
        return best

    def _remembered(self, words: pa.Array) -> np.ndarray:
        known, margins = getattr(self, "_known", (pa.array([], pa.large_string()), np.empty(0)))
        places = pc.index_in(words, value_set=known)
        missing = pc.is_null(places)
        out = pc.fill_null(places, 0).to_numpy(zero_copy_only=False).copy()
        if places.null_count:
            coded = words.filter(missing).dictionary_encode()
            if len(known) and len(known) + len(coded.dictionary) > REMEMBERED:
                self._known = (known.slice(0, 0), np.empty(0))
                return self._remembered(words)
            out[missing.to_numpy(zero_copy_only=False)] = len(known) + coded.indices.to_numpy()
            known = pa.concat_arrays([known, coded.dictionary])
            margins = np.concatenate([margins, self.word_margins(coded.dictionary.to_pylist())])
            self._known = (known, margins)
        return margins[out] if len(out) else np.empty(0)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _logistic(margins: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    x, w = np.stack([margins, np.ones(len(y))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _words_of(sentences: list[str]) -> tuple[list[str], np.ndarray]:
    split = [s.lower().split() for s in sentences]
    return [w for ws in split for w in ws], np.repeat(np.arange(len(split)), [len(ws) for ws in split])


def _flat(share: float) -> Model:
    odds = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    return Model(np.full(_CODES ** 4, -1, "i4"), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, odds, [])


def apart(words: list[str], most: int = LANDMARKS) -> list[str]:
    """The words, in order, but those for which one before them stands."""
    word, index, weight = _summed(*_entries(words))
    used, index = np.unique(index, return_inverse=True)
    weight = weight / np.sqrt(np.bincount(word, weights=weight * weight, minlength=len(words)))[word]
    first = np.searchsorted(word, np.arange(len(words) + 1))
    rows, out = np.zeros((most, len(used)), "f4"), []
    for i, w in enumerate(words):
        at, x = index[first[i]:first[i + 1]], weight[first[i]:first[i + 1]]
        if len(out) < most and len(at) and (rows[:len(out), at] @ x < STANDS).all():
            rows[len(out), at] = x
            out.append(w)
    return out


def landmark_model(words: list[str], others: list[str]) -> Model:
    names = words + others
    place, matrix = landmark_features(names)
    return Model(place, matrix, np.zeros(len(names)), 0.0, 1.0, 0.0, names, len(words))


def _distorted(words: list[str], seed: int = 11) -> list[str]:
    """The words with a letter put in, at INSERTED places each, and with a letter
    repeated."""
    rng = np.random.default_rng(seed)
    out = []
    for w in words:
        for _ in range(INSERTED):
            at, letter = int(rng.integers(1, len(w))), chr(97 + int(rng.integers(26)))
            out.append(w[:at] + letter + w[at:])
        out.append(w[:at] + w[at - 1:])
    return out


def fit(toxic: list[str], clean: list[str], words: list[str], others: list[str]) -> Model | None:
    """The machine, its curve not fitted yet.  ``toxic`` sentences hold one of
    ``words``, ``others`` are the landmarks of clean text.  The words of toxic
    sentences also train in distorted form."""
    model = landmark_model(words, others)
    matrix = model.matrix
    between = (matrix.T.astype("f8") @ matrix) ** DEGREE
    value, vector = np.linalg.eigh(between)
    root = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6])
    found, text = _words_of(toxic)
    at, rows = model.near(found)
    no = model.near(sorted(set(_words_of(clean)[0])))[1]
    if not len(rows):
        return None
    # A toxic sentence gives the word nearest to a toxic landmark.
    text = text[at]
    order = np.lexsort((-rows[:, :len(words)].max(axis=1), text))
    first = order[np.unique(text[order], return_index=True)[1]]
    yes = np.vstack([rows[first], model.near(_distorted([found[at[i]] for i in first if len(found[at[i]]) > 1]))[1]])
    blank = np.zeros((1, matrix.shape[1]))
    x = np.vstack([yes, no, blank]) ** DEGREE @ root
    w, bias = train_svm(x, np.concatenate([np.ones(len(yes)), -np.ones(len(no) + 1)]))
    model = Model(model.place, matrix, root @ w, float(bias), 1.0, 0.0, model.landmarks, len(words))
    # Other distortions than the machine has seen.
    model.distorted = model.word_margins(_distorted([found[at[i]] for i in first if len(found[at[i]]) > 1], 12))
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on labelled documents outside the held-out fold.

    The driver keeps the model only: what training took beside it would stay in
    its process through all later stages.
    """
    map_large_blocks()
    try:
        return _train(docs, labels, doc_id, text, label, sample)
    finally:
        give_back()


def _train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int) -> Model:
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
             .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("int").alias("toxic")))
    chosen = None
    for side in (0, 1):
        part = known.where(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample * (1 if side else CLEAN))
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most CLEAN + 1 samples of ids: the broadcast and the rows below are bounded.
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
                .join(F.broadcast(chosen), "doc_id"))
    # Near copies mostly share the smallest hash of their runs of four words.
    near = let(F.split(F.lower("text"), r"\s+"), lambda w: F.coalesce(F.array_min(F.transform(
        F.slice(w, 4, F.greatest(F.size(w) - 3, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))), F.xxhash64(F.array_join(w, " "))))
    rows = rows.withColumn("near", near).dropDuplicates(["near"]).select("doc_id", "toxic", "text").cache()
    sentence = F.explode(F.flatten(F.transform(F.split("text", r"[.!?\n]+"), lambda s: F.regexp_extract_all(
        s, F.lit(f"(?s).{{1,{SENTENCE_CHARS}}}"), F.lit(0)))))
    cut = rows.select("doc_id", "toxic", sentence.alias("s")).where(F.length(F.trim("s")) > 0)
    counts = rows.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in counts}
    n_yes, n_no = n.get(1, 0), n.get(0, 0)
    each = (cut.select("doc_id", "toxic", F.explode(F.split(F.lower("s"), r"[^\p{L}]+")).alias("word"))
               .where(F.length("word") >= 2).distinct().groupBy("word")
               .agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no")))
    odds = F.log((F.col("yes") + 0.5) / (n_yes + 1)) - F.log((F.col("no") + 0.5) / (n_no + 1))
    each = each.withColumn("odds", odds).cache()
    # The share of toxic documents among all that hold a word, of every word: long
    # documents hold more words.
    sums = each.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).first()
    share = min(max((sums["yes"] or 0) / max((sums["yes"] or 0) + (sums["no"] or 0), 1), 1e-6), 1 - 1e-6)
    both = F.col("yes") + F.col("no")
    # Chernoff's bound of the chance of as many toxic documents or more.
    part = lambda c, q: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (both * q))).otherwise(0.0)
    chance = F.when(F.col("yes") > both * share, F.exp(-part("yes", share) - part("no", 1 - share))).otherwise(1.0)
    tested = each.where(both >= LEAST)
    n_tested = tested.count()
    found = (tested.where((F.col("yes") >= LEAST) & (F.col("odds") >= 1)).select("word", chance.alias("p"))
                   .orderBy("p", "word").limit(TOXIC_WORDS).collect())
    passed = [i + 1 for i, r in enumerate(found) if r["p"] <= FALSE_SHARE * (i + 1) / n_tested]
    strong = [r["word"] for r in found[:max(passed, default=0)]]
    marks = apart(strong) if strong else []
    others = [r["word"] for r in
              each.where(F.col("odds") < 0.5).orderBy(F.desc("no"), "word").limit(LANDMARKS // 4).collect()]
    each.unpersist()
    model = None
    if marks and n_yes and n_no:
        ship(docs.sparkSession)
        held = F.lower("s").rlike(r"(?<!\p{L})(" + "|".join(strong) + r")(?!\p{L})")
        toxic = cut.where((F.col("toxic") == 1) & held).select("s")
        clean = cut.where(F.col("toxic") == 0).select("s").mapInArrow(lean(_alike(landmark_model(marks, others))), "s string")
        some = [[r["s"] for r in part.orderBy(F.xxhash64("s"), "s").limit(SENTENCES).collect()]
                for part in (toxic, clean)]
        model = fit(*some, marks, others)
    if model is None:
        model = _flat(n_yes / max(n_yes + n_no, 1))
    else:
        seen = rows.select("toxic", "text").mapInArrow(lean(_margins(model)), "toxic int, margin double").toPandas()
        # Toxic documents count once as they are and once distorted; clean ones
        # as much as a sample of SAMPLE.
        more, y = model.distorted, seen["toxic"].to_numpy().astype("f8")
        weight = np.where(y > 0, 1.0, min(1.0, sample / n_no))
        model.slope, model.shift = _logistic(
            np.concatenate([seen["margin"].to_numpy(), more]), np.concatenate([y, np.ones(len(more))]),
            np.concatenate([weight, np.full(len(more), DISTORTED * n_yes / max(len(more), 1))]))
        model.distorted = None
    rows.unpersist()
    return model


def _alike(model: Model):
    """Sentences with words near a landmark."""
    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            words, text = _words_of(texts)
            some = np.unique(text[model.near(words)[0]])
            yield pa.RecordBatch.from_arrays([pa.array([texts[i] for i in some], pa.string())], names=["s"])
    return run


def _margins(model: Model):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.margins(batch.column(1)))],
                                             names=["toxic", "margin"])
    return run


def _score(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            score = model.scores(model.margins(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype("i4"))],
                names=["doc_id", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # A few MB: weights of at most LANDMARKS words.  Broadcast, a worker's tasks
    # share one model and the words it remembers.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(lean(_score(shared)), "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def _reject(shared, text_at: int):
    def run(batches):
        model = shared.value
        for batch in batches:
            score = model.scores(model.margins(batch.column(text_at).cast(pa.large_string())))
            yield batch.filter(pa.array(score < THRESHOLD))
    return run


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    model = train(docs, labels, text=text)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lean(_reject(shared, docs.columns.index(text))), docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
