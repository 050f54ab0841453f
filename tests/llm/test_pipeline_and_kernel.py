"""The corpus pipeline as a whole, and the toxicity kernel and machine, against
plain versions."""

import itertools
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tillroll.llm import decontam, secret_scan, toxicity
from tillroll.llm.tokens import default_vocabulary

from .test_texts import BAD, brute_components, passage

# -- the kernel and the machine


def plain_features(word):
    """Weight of every subsequence of four symbols within six places."""
    symbols = ["^", *word, "^"]
    out = {}
    for at in itertools.combinations(range(len(symbols)), 4):
        if at[3] - at[0] < toxicity.SPAN:
            key = "".join(symbols[i] for i in at)
            out[key] = out.get(key, 0) + toxicity.GAP ** (at[3] - at[0] - 3)
    return out


def plain_kernel(x, y):
    a, b = plain_features(x), plain_features(y)
    length = np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(v * b.get(k, 0) for k, v in a.items()) / length if length else 0.0


def test_kernel_counts_subsequences():
    rng = random.Random(2)
    words = ["ab", "abc", "nasty", "naasty", "nsty", "villain", "viillain", "aaaaaaa", "abababab"]
    words += ["".join(rng.choice("abcn") for _ in range(rng.randint(2, 12))) for _ in range(25)]
    _, matrix = toxicity.landmark_features(words)
    want = [[plain_kernel(x, y) for y in words] for x in words]
    assert np.allclose(matrix.T @ matrix, want, atol=1e-5)
    assert plain_kernel("villain", "viillain") > plain_kernel("villain", "villages") > plain_kernel("villain", "orchard")


def test_near_words_have_their_kernels():
    marks, words = ["nasty", "villain", "rotten"], ["naasty", "vilain", "orchard", "rotten", "n-a-s-t-y", ""]
    model = toxicity.landmark_model(marks, ["orchard"])
    places, kernels = model.near(words)
    plain = [w.replace("-", "") for w in words]
    want = {i: [plain_kernel(p, m) for m in (*marks, "orchard")] for i, p in enumerate(plain)}
    assert sorted(places) == [i for i, k in want.items() if max(k[:3]) >= toxicity.FLOOR]
    for i, k in zip(places, kernels):
        assert np.allclose(k, want[i], atol=1e-5)


@pytest.mark.parametrize("seed", range(3))
def test_machine_minimises_its_objective(seed):
    """Against plain gradient descent on the same squared hinge."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0.6, 1.0, -1.0)
    cost = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum()) * len(y) / 2

    def objective(w, bias):
        return w @ w / 2 + 0.5e-6 * bias * bias + (cost * np.maximum(0, 1 - y * (x @ w + bias)) ** 2).sum() / 2

    w, bias = np.zeros(4), 0.0
    for _ in range(20_000):
        slack = cost * np.maximum(0, 1 - y * (x @ w + bias)) * y
        w, bias = w - 2e-3 * (w - x.T @ slack), bias - 2e-3 * (1e-6 * bias - slack.sum())
    got = toxicity.train_svm(x, y)
    assert objective(*got) <= objective(w, bias) + 1e-6
    assert np.allclose(got[0], w, atol=1e-3) and abs(got[1] - bias) < 1e-3


# -- the pipeline

KEY = "password = 'Zx81kQpLm2vT9'"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents of which it is known what each stage should do."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(passage(rng, 9)) for _ in range(5)]
        if i % 4 == 0:
            sentences[rng.randrange(5)] += f" you {rng.choice(BAD)} thing"
        rows.append((i, ". ".join(sentences)))
        labels.append((i, 1, int(i % 4 == 0)))
    items = [(i, " ".join(passage(rng, 30))) for i in range(5)]
    calm = [(i, t) for i, t in rows if i % 4]
    more = [(1000 + k, t) for k, (_, t) in enumerate(calm[:20])]                              # copies
    more += [(1100 + k, t + " one more word here") for k, (_, t) in enumerate(calm[20:40])]     # near copies
    more += [(1200 + k, f"{calm[50 + k][1][::-1]} {items[k % 5][1]} end") for k in range(10)]   # benchmark passages
    more += [(1300 + k, f"{' '.join(passage(rng, 40))} {KEY} after") for k in range(10)]        # secrets
    more += [(1400, None), (1401, ""), (1402, " ".join(passage(rng, 6000))), (None, " ".join(passage(rng, 50)))]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = [(i, t, "en", "web", None if t is None else len(t)) for i, t in rows + more]
    for name, data, schema in (
            ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder, items


@pytest.fixture(scope="module")
def stages(spark, corpus):
    """The input and the result of every stage, run one after the other."""
    folder, _ = corpus
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = f"{folder}/after-{name.replace(' ', '-')}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (before, docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near duplicates", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_all_but_the_last_keep_the_columns(spark, corpus, stages):
    columns = spark.read.parquet(f"{corpus[0]}/documents.parquet").columns
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == columns, name


def test_toxic_documents_go_and_clean_ones_stay(stages):
    before, after = map(texts, stages["toxicity"])
    toxic = {i for i, t in before.items() if set((t or "").replace(".", "").split()) & set(BAD)}
    assert len(toxic) == 100 and len(set(after) & toxic) <= 5
    assert len(set(before) - set(after) - toxic) <= 3


def test_one_of_each_group_stays(stages):
    before, after = stages["near duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    component = {i: c for i, _, c in brute_components(rows, 5, 80)}
    want = {i for i, _ in rows if i is None or component[i] == i}
    assert set(texts(after)) == want and len(want) <= len(rows) - 40


def test_no_copy_of_an_item_stays(corpus, stages):
    """Held against the alignment of every document with every item."""
    before, after = map(texts, stages["benchmark decontamination"])
    number: dict[str, int] = {}

    def numbers(text):
        words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        return np.array([number.setdefault(w, len(number)) for w in words], "i8")
    items = [numbers(t) for _, t in corpus[1]]
    held = {i for i, t in before.items() for own in items
            if len(t or "") and decontam.align(own, numbers(t))[0] >= decontam.least_score(len(own))}
    assert set(after) == set(before) - held and len(held) == 10


def test_secrets_are_masked_and_lengths_renewed(stages):
    before, after = stages["secret scans"]
    was, now = texts(before), {r["doc_id"]: r for r in after.collect()}
    assert set(was) == set(now)
    spans = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.secret_spans(before)).collect()}
    for i, t in was.items():
        got = now[i]["text"]
        assert "Zx81kQpLm2vT9" not in (got or "") and now[i]["n_chars"] == (None if got is None else len(got))
        assert ("[secret]" in (got or "")) == bool(spans[i]["spans"]) and (spans[i]["spans"] or got == t)
    assert sum(KEY in (t or "") for t in was.values()) == 10


def test_sequences_hold_every_token_once(stages):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(default_vocabulary())
    docs, pieces = stages["best-fit packing"]
    rows = pieces.collect()
    found: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["piece"])):
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    lengths = []
    for i, t in texts(docs).items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cut = [(a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for a in range(0, len(ids), 2048)]
        assert found.pop(i) == cut
        lengths += [n for _, n, _ in cut]
    assert not found
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    # No more than best fit piece by piece takes.
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is not None:
            rooms.remove(fit)
        rooms.append((2048 if fit is None else fit) - n)
    assert len(sequences) <= len(rooms)


def test_run_applies_the_stages_in_turn(spark, corpus, stages):
    got = corpus_pipeline.run(spark, corpus[0])
    want = stages["best-fit packing"][1]
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, got.select(own).collect())) == sorted(map(str, want.select(own).collect()))
    assert got.select("sequence_id").distinct().count() == want.select("sequence_id").distinct().count()


def test_empty_tables_run_through(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 3
