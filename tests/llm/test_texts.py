"""Near-duplicate join, decontamination, toxicity and edit counts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import decontam, edit_counts, jaccard, toxicity
from tillroll.llm.graph import components
from tillroll.llm.tokens import default_vocabulary, encoder

from .conftest import ODD


def shingle_set(text, k):
    w = [x for x in re.split(r"[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute_components(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]) and both:
                root[find(i)] = find(j)
    ids = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            ids[find(i)] = min(ids.get(find(i), name), name)
    return Counter((name, len(sets[i]), ids.get(find(i))) for i, (name, _) in enumerate(rows))


def copies(seed, sizes=(3, 9, 12, 40, 120, 400)):
    """Texts with chains and stars of edited copies, and short ones."""
    rng = random.Random(seed)
    rows = list(ODD)
    for size in sizes:
        base = [f"w{rng.randint(0, 900)}" for _ in range(size)]
        for c in range(14):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, size // 30])):
                text[rng.randrange(size)] = f"v{rng.randint(0, 10**6)}"
            if rng.random() < 0.3:
                base = text                          # a chain
            if rng.random() < 0.3:
                text = text + [f"t{i}" for i in range(max(1, size // 20))]
            rows.append((100 + len(rows), rng.choice([" ", "\n", " \t"]).join(text).title()))
    common = " ".join(f"c{i}" for i in range(12))
    rows += [(1000 + i, common + " " + " ".join(f"u{i}-{j}" for j in range(8))) for i in range(30)]
    return rows


@pytest.mark.parametrize("k, percent, seed", [(3, 90, 1), (5, 80, 2), (2, 60, 3)])
def test_components_against_all_pairs(documents, k, percent, seed):
    rows = copies(seed)
    got = Counter(map(tuple, jaccard.near_duplicates(documents(rows), k, percent).collect()))
    assert got == brute_components(rows, k, percent)


def test_every_link_has_a_common_key():
    """Sets at the limit of the threshold agree in a part of some tile."""
    rng = np.random.default_rng(1)
    for percent in (90, 80):
        tiles = jaccard.Tiles(percent)
        for _ in range(300):
            n = int(rng.integers(2, 300))
            union = rng.integers(0, 1 << 63, n, dtype="i8").astype("u8")
            miss = n * (100 - percent) // 100
            side = rng.integers(0, 2, miss)
            drop = rng.permutation(n)[:miss]
            a, b = (np.unique(np.delete(union, drop[side == s])) for s in (0, 1))
            if len(a) and len(b) and not np.array_equal(a, b):
                assert np.intersect1d(jaccard.part_keys(a, tiles), jaccard.part_keys(b, tiles)).size


def test_unrelated_sets_share_no_key():
    """Nothing but shingles in common makes candidates: groups of sets that have
    the same part empty would grow with the square of the table."""
    rng = np.random.default_rng(2)
    tiles = jaccard.Tiles(80)
    sets = [np.unique(rng.integers(0, 1 << 64, int(n), dtype="u8")) for n in rng.integers(60, 3000, 500)]
    keys = [jaccard.part_keys(s, tiles) for s in sets]
    assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))
    assert sum(map(len, keys)) < 0.4 * sum(map(len, sets))


def test_sets_with_few_filled_parts_are_found_too(monkeypatch):
    """Bands of too few parts: some sets fill no d + 1 and are found by all."""
    monkeypatch.setattr(jaccard, "DEVIATIONS", -8)
    rng, few = np.random.default_rng(3), 0
    for percent in (80, 60, 50):
        tiles = jaccard.Tiles(percent)
        for _ in range(400):
            n = int(rng.integers(2, 400))
            union = rng.integers(0, 1 << 63, n, dtype="i8").astype("u8")
            drop = rng.permutation(n)[:n * (100 - percent) // 100]
            side = rng.integers(0, 2, len(drop)) if rng.random() < 0.5 else np.zeros(len(drop), "i8")
            a, b = (np.unique(np.delete(union, drop[side == s])) for s in (0, 1))
            if len(a) and len(b) and not np.array_equal(a, b):
                keys = [jaccard.part_keys(x, tiles) for x in (a, b)]
                assert np.intersect1d(*keys).size
                few += any(len(k) > sum(d + 1 for _, _, d in tiles.of(len(x)) if d) for k, x in zip(keys, (a, b)))
    assert few > 50


def test_forests_of_one_turn_have_no_pair_in_common():
    rng = random.Random(5)
    base = rng.sample(range(1, 1 << 40), 60)
    sets = [np.unique(np.array(rng.sample(base, 58) + rng.sample(range(1 << 41, 1 << 42), 2), "u8")) for _ in range(12)]
    table = pa.table({"side": [0] * 12, "class": list(range(12)), "root": list(range(12)), "n": [len(s) for s in sets],
                      "bits": pa.array([jaccard.signature(s) for s in sets], pa.binary()),
                      "tried": pa.array([[1]] + [None] * 11, pa.list_(pa.int64()))})
    pairs = jaccard._block_forest(80, 3)(None, table)
    found = [frozenset(p) for p in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())]
    # The first joins 0 with all others but 1, so 0 has no pair left for the next.
    assert len(found) == len(set(found)) == 11 + 10 + 9 and frozenset((0, 1)) not in found


def test_rows_without_a_pair_left_leave_the_group():
    """Of a component of 30 near copies, one is close to the one row outside."""
    rng = random.Random(6)
    base = rng.sample(range(1, 1 << 40), 60)
    sets = [np.unique(np.array(base[:52] + rng.sample(range(1 << 41, 1 << 42), 8), "u8")) for _ in range(30)]
    sets += [np.unique(np.array(rng.sample(range(1 << 43, 1 << 44), 60), "u8")) for _ in range(2)]
    sets.append(np.unique(np.append(sets[0][4:], np.array([1 << 50, 1 << 51], "u8"))))
    table = pa.table({"side": [0] * 33, "class": list(range(33)), "root": [0] * 30 + [30, 31, 32], "n": [len(s) for s in sets],
                      "bits": pa.array([jaccard.signature(s) for s in sets], pa.binary()),
                      "tried": pa.array([None] * 33, pa.list_(pa.int64()))})
    more = jaccard._block_forest(80, 1, True)(None, table).to_pylist()
    allowed = {i for i in range(30) if 100 * len(np.intersect1d(sets[i], sets[32])) >= 80 * len(np.union1d(sets[i], sets[32]))}
    assert allowed == {0} and [(r["a"], r["b"]) for r in more] == [(0, 32)]
    table = table.set_column(5, "tried", pa.array([[32]] + [None] * 32, pa.list_(pa.int64())))
    assert jaccard._block_forest(80, 1, True)(None, table).num_rows == 0
    table = table.set_column(2, "root", pa.array(list(range(33)))).set_column(5, "tried", pa.array([None] * 33, pa.list_(pa.int64())))
    left = [r["a"] for r in jaccard._block_forest(60, 1, True)(None, table).to_pylist() if r["b"] is None]
    assert set(range(1, 30)) <= set(left) and not {30, 31} & set(left)


def test_one_of_each_group_stays(documents):
    rows = copies(4, (30, 90))
    got = jaccard.one_of_each(documents(rows), 5, 80)
    assert got.columns == documents([]).columns
    kept = Counter(r["doc_id"] for r in got.collect())
    want = brute_components(rows, 5, 80)
    names = {c for name, _, c in want if name is not None}
    assert {i for i in kept if i is not None} == names and kept[None] == 1 and set(kept.values()) == {1}


def test_components_of_a_long_path(spark):
    rng = random.Random(2)
    names = list(range(200))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(199) if i != 100] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(set(got.values())) == 2 and {got[n] for n in names[:101]} != {got[n] for n in names[101:]}


WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "ren", "sol") for b in ("ta", "ri", "no", "pel", "dus", "x", "gan")]


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def test_benchmark_copies_exact_and_edited(spark, documents):
    rng = random.Random(8)
    items = [(i, " ".join(passage(rng, rng.randint(16, 50)))) for i in range(20)]
    rows, want = list(ODD), set()
    for i, (item, text) in enumerate(items):
        w = text.split()
        edited = [f"new{j}" if j % 9 == 4 else x for j, x in enumerate(w) if j % 13 != 7]
        for c, body in enumerate((text.upper().replace(" ", ", "), " ".join(edited), " ".join(w[:3]))):
            rows.append((100 + 10 * i + c, " ".join(passage(rng, 80) + [body] + passage(rng, 80))))
            if c < 2:
                want.add((100 + 10 * i + c, item))
    bench = spark.createDataFrame(items + [(50, None), (51, ""), (52, "two words"), items[0], (None, "a b c d e f g h")],
                                  "item_id long, text string")
    docs = documents(rows)
    got = decontam.benchmark_copies(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["score"] > 0.99 and r["last_word"] - r["first_word"] == len(items[r["item_id"]][1].split())
               for r in got if r["doc_id"] % 10 == 0)
    left = decontam.without_copies(docs, bench)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, _ in rows if i not in {d for d, _ in want})
    assert decontam.benchmark_copies(docs.limit(0), bench).collect() == []
    assert decontam.benchmark_copies(docs, bench.limit(0)).collect() == []


def held_copies(items, texts):
    block = decontam._read_items([{"item_id": i, "text": t} for i, t in items])
    counts = np.zeros(len(block.vocabulary), "i8")
    for batch in decontam._count_documents(block.vocabulary)([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])]):
        for w, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[w] += n if w >= 0 else 0
    decontam.choose_seeds(block, counts, len(texts))
    return block, decontam._best_copies(block, pa.array(texts), decontam._filter(block.vocabulary))


@pytest.mark.parametrize("every", [3, 4, 5, 6])
def test_copies_with_every_nth_word_replaced_are_found(every):
    """Also beside an exact copy, and with words put in instead."""
    rng = random.Random(every)
    items = [(i, " ".join(passage(rng, 30))) for i in range(20)]
    texts = []
    for _, text in items:
        w = text.split()
        replaced = [f"new{j}" if j % every == every - 1 else x for j, x in enumerate(w)]
        more = [x for j, x in enumerate(w) for x in ([x, f"new{j}"] if j % every == every - 1 else [x])]
        texts += [" ".join(passage(rng, 80) + body + passage(rng, 80)) for body in (replaced, more, w)]
    assert set(held_copies(items, texts)[1]) >= {(k, k // 3) for k in range(len(texts))}


def test_copies_against_alignment_of_everything(monkeypatch):
    """Short alphabets, items of 1 to 50 words: every alignment that reaches the
    limit is found with its score, and no other."""
    monkeypatch.setattr(decontam, "PIECE", 2000)
    rng = random.Random(3)
    for n_words in (6, 42):
        some = lambda n: [rng.choice(WORDS[:n_words]) for _ in range(n)]  # noqa: E731,B023
        items = [(i, " ".join(some(rng.randint(1, 50)))) for i in range(30)]
        texts = [" ".join(some(rng.randint(0, 300))) for _ in range(20)]
        for _, text in items:
            body = [x for x in text.split() if rng.random() < 0.8]
            texts.append(" ".join(some(60) + [y for x in body for y in ([x] if rng.random() < 0.8 else [x, "new"])] + some(40)))
        block, got = held_copies(items, texts)
        words, starts = decontam._places(pa.array(texts), block.vocabulary, decontam._filter(block.vocabulary))
        want = {}
        for t in range(len(texts)):
            for i, own in enumerate(block.words):
                score = decontam.align(own, words[starts[t]:starts[t + 1]])[0]
                if len(own) >= decontam.LEAST and score >= decontam.MATCH * min(decontam.SHARE * len(own), decontam.WORDS):
                    want[t, i] = score
        assert {k: v[0] for k, v in got.items()} == want


def test_alignment_against_the_plain_recurrence():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(1, 25)).astype("u8") for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        score, i, j = decontam.align(a, b)
        assert score == h.max() and (score == 0 or h[i, j] == score)


BAD = ["nasty", "rotten", "villain", "crooked", "awful"]


def labelled(n=400, seed=6):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        sentences = [" ".join(passage(rng, 8)) for _ in range(5)]
        if toxic:
            sentences[rng.randrange(5)] += f" you {rng.choice(BAD)} thing"
        rows.append((i, ". ".join(sentences)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_and_tolerates(spark, documents):
    rows, labels = labelled()
    docs = documents(ODD[1:4] + [(1000 + i, t) for i, t in rows])
    table = spark.createDataFrame([(1000 + i, q, t) for i, q, t in labels] + [(1000, 1, None), (None, 1, 1), (2000, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, table)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == docs.count()
    held = [(got[1000 + i], t) for i, _, t in labels if got[1000 + i]["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == t for r, t in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert got[1]["score"] == got[2]["score"] == got[3]["score"] < 0.3
    calm = rows[1][1]
    hidden = [calm + f" you {w} thing" for w in ("n.a.s.t.y", "V-I-L-L-A-I-N", "r o t t e n", "vil_lain###", "viillain")]
    scores = model.scores(model.margins(pa.array([calm, *hidden])))
    assert (scores[1:] > scores[0]).all() and (scores[1:5] >= 0.3).all()
    left = toxicity.without_toxic(docs, table)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, r in got.items() if not r["predicted"])


def test_toxicity_finds_inserted_and_repeated_letters(spark, documents):
    rows, labels = labelled()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(documents(rows), table)
    rng, hidden = random.Random(7), []
    fold = {r[0] for r in table.where(toxicity.held_out(table.doc_id)).select("doc_id").collect()}
    calm = [t for (i, t), (_, _, y) in zip(rows, labels) if not y and i in fold]
    for text in calm:
        w = rng.choice(BAD)
        at = rng.randrange(1, len(w))
        hidden += [f"{text} you {w[:at]}{x}{w[at:]} thing" for x in (rng.choice("abcdefghijklmnopqrstuvwxyz"), w[at - 1])]
    assert (model.scores(model.margins(pa.array(hidden))) >= 0.3).mean() >= 0.95
    assert (model.scores(model.margins(pa.array(calm))) >= 0.3).mean() <= 0.03


def test_toxicity_finds_rare_short_and_small_languages_words(spark, documents):
    """Insults of three letters, and of a language with one in 25 toxic labels."""
    rng, rows, labels = random.Random(9), [], []
    for i in range(1600):
        toxic, other = i % 4 == 0, i % 100 == 0
        text = passage(rng, 30) if i % 25 else [w[::-1] + "o" for w in passage(rng, 30)]
        if toxic:
            text[7] = ("zwx" if i % 8 else "vqjkfg") if not other else "hbgyd"
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(documents(rows), table).collect()}
    for word in ("zwx", "vqjkfg", "hbgyd"):
        held = [got[i]["predicted"] for i, t in rows if got[i]["held_out"] and word in t.split()]
        assert held and sum(held) >= 0.9 * len(held)
    clean = [got[i]["predicted"] for i, _, y in labels if not y]
    assert sum(clean) <= 0.03 * len(clean)


def test_toxicity_ignores_labels_of_the_held_out_fold(spark, documents):
    rows, labels = labelled(200)
    docs = documents(rows)
    schema = "doc_id long, quality int, toxic int"
    table = spark.createDataFrame(labels, schema)
    fold = {r[0] for r in table.where(toxicity.held_out(table.doc_id)).select("doc_id").collect()}
    flipped = spark.createDataFrame([(i, q, 1 - t if i in fold else t) for i, q, t in labels], schema)
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, t).collect())) for t in (table, flipped))
    assert a == b


def test_toxicity_without_labels(spark, documents, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity(odd, none).collect()} == {0}
    assert toxicity.toxicity(odd.limit(0), none).collect() == []


def token_count(text):
    return len(encoder(default_vocabulary()).library.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(6))
def test_trees_follow_edits(seed):
    rng = random.Random(seed)
    parts = ["ab", "hello", " ", "  ", "\n", "é", "it's", "x,y", "　", "日", "1", ".", " the "]
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 150)))
        leaves = edit_counts._LEAVES.findall(text)
        assert "".join(leaves) == text
        edits = [{"start": rng.choice([None, rng.randint(-2, len(text) + 3)]), "end": rng.randint(0, len(text) + 3),
                  "replacement": rng.choice(["", None, " ", "zz", "a b", "'s", "\n\n"])} for _ in range(rng.randint(0, 8))]
        todo = edit_counts.in_order(edits, len(text))
        doc = edit_counts.Document(text, *(edit_counts.heap(np.array([f(x) for x in leaves], "i8"))
                                           for f in (len, token_count)), token_count)
        for e in reversed(todo):
            doc.edit(*e)
        new = edit_counts.edited(text, todo)
        assert (doc.tokens[1], doc.chars[1]) == (token_count(new), len(new))
        assert (doc.tokens[1:doc.size] == doc.tokens[2::2] + doc.tokens[3::2]).all()


def test_counts_of_the_query(odd):
    rows = edit_counts.edit_counts(odd).collect()
    assert len(rows) == len(ODD)
    texts = dict(ODD)
    for r in rows:
        assert r["tokens_before"] == token_count(texts[r["doc_id"]]) and r["tokens_after"] == token_count(r["new_text"])
        assert r["chars_after"] == len(r["new_text"])
    assert edit_counts.edit_counts(odd.limit(0)).collect() == []


def test_edits_as_a_table(spark, documents):
    docs = documents([(1, "one two three"), (2, "four"), (3, None)])
    edits = spark.createDataFrame([(1, 4, 7, "2 2"), (1, 0, 3, None), (9, 0, 1, "x"), (3, 0, 5, "new")],
                                  "doc_id long, start long, end long, replacement string")
    got = {r["doc_id"]: r for r in edit_counts.apply_edits(
        edit_counts.with_edits(edit_counts.build_trees(docs), edits)).collect()}
    assert {i: r["new_text"] for i, r in got.items()} == {1: " 2 2 three", 2: "four", 3: "new"}
    assert all(r["tokens_after"] == token_count(r["new_text"]) for r in got.values())


@pytest.mark.parametrize("seed", range(12))
def test_block_forests_join_what_all_pairs_would(seed):
    """With signatures too short to tell much, verified forests in turns give
    the components of all links, and never more rows than candidates."""
    rng = random.Random(seed)
    base = rng.sample(range(1, 1 << 40), 40)
    sets = [np.unique(np.array(rng.sample(base, 36) + rng.sample(range(1 << 41, 1 << 42), rng.randint(0, 4)), "u8"))
            for _ in range(40)]
    percent = 85
    linked = [[100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)) for y in sets] for x in sets]
    bits = [np.packbits((np.bincount((s % np.uint64(64)).astype("i8"), minlength=64) & 1).astype("u1")).tobytes() for s in sets]
    names = [bytes([i]) for i in range(len(sets))]
    root, tried, turns = list(range(len(sets))), [set() for _ in sets], 0
    while True:
        found = set()
        for i, j in ((0, 0), (0, 1), (1, 1)):
            rows = [(0 if x % 2 == i else 1, x) for x in range(len(sets)) if x % 2 in (i, j)]
            table = pa.table({
                "side": [s for s, _ in rows], "class": pa.array([names[x] for _, x in rows], pa.binary()),
                "root": pa.array([names[root[x]] for _, x in rows], pa.binary()), "n": [len(sets[x]) for _, x in rows],
                "bits": pa.array([bits[x] for _, x in rows], pa.binary()),
                "tried": pa.array([[names[y] for y in sorted(tried[x])] or None for _, x in rows], pa.list_(pa.binary()))})
            out = jaccard._block_forest(percent)(None, table)
            assert out.num_rows < len(rows)
            found |= {(a[0], b[0]) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist())}
        assert all(b not in tried[a] and a not in tried[b] and root[a] != root[b] for a, b in found)
        if not found:
            break
        turns += 1
        for a, b in found:
            if linked[a][b]:
                x, y = sorted((root[a], root[b]))
                root = [x if r == y else r for r in root]
            else:
                tried[a].add(b)
    want = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if linked[a][b]:
                x, y = sorted((want[a], want[b]))
                want = [x if r == y else r for r in want]
    assert root == want and turns


def test_rows_of_open_pairs_grow_with_the_group(spark):
    """Twice the near copies: about twice the rows, and no more than candidates."""
    made = []
    for size in (150, 300):
        rng = random.Random(3)
        base = rng.sample(range(1, 1 << 40), 60)
        sets = [np.unique(np.array(rng.sample(base, 58) + rng.sample(range(1 << 41, 1 << 42), 2), "u8")) for _ in range(size)]
        rows = [(bytes([i >> 8, i & 255]), len(s), jaccard.signature(s)) for i, s in enumerate(sets)]
        small = spark.createDataFrame(rows, "class binary, n long, bits binary")
        groups = small.select("class").crossJoin(spark.createDataFrame([(1,), (2,)], "key long"))
        none = spark.createDataFrame([], "a binary, b binary")
        roots = spark.createDataFrame([], "node binary, root binary")
        made.append(jaccard._open_pairs(groups, roots, small, none, 80).select("a", "b").distinct().count())
    assert made[0] < 150 and made[1] < 300
