"""Spelling variants, SimHash near duplicates and periodic runs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillroll.llm import periodic, simhash, variants

from .conftest import ODD


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


# -- periodic runs

def brute_runs(words, least, times):
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                best.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((a, z - a, q) for (a, z), q in best.items())


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([(24, 3), (3, 3), (6, 3), (4, 2), (24, 2), (30, 4)]), st.booleans())
def test_catcher_finds_all_runs_however_words_are_appended(seed, shape, at_once):
    rng = random.Random(seed)
    words = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 160))]
    for _ in range(rng.randint(0, 3)):
        if words:
            a = rng.randrange(len(words))
            p = rng.randint(1, max(1, (len(words) - a) // 3))
            for i in range(a, rng.randint(a, len(words))):
                words[i] = words[a + (i - a) % p]
    catcher = periodic.SquareCatcher(*shape)
    at = 0
    while at < len(words):
        step = len(words) if at_once else rng.randint(1, 50)
        catcher.append(np.array(words[at:at + step], "i8"))
        at += step
    assert catcher.runs() == brute_runs(words, *shape)


def test_catcher_in_highly_periodic_and_long_sequences():
    one = periodic.SquareCatcher()
    for _ in range(4):
        one.append(np.zeros(periodic.PIECE, "i8"))
    assert one.runs() == [(0, 4 * periodic.PIECE, 1)]
    long = periodic.SquareCatcher()
    words = np.concatenate([[-1], np.arange(200_000) % 60_001, [-2]])
    for at in range(0, len(words), periodic.PIECE):
        long.append(words[at:at + periodic.PIECE])
    assert long.runs() == [(1, 200_000, 60_001)]


def brute_document(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 24, 3)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
    return (doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def periodic_texts(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(100, 220):
        words = [rng.choice(["a", "b", "Été", "A"]) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 2)):
            block = words[:rng.randint(0, 9)] if rng.random() < 0.5 else [rng.choice("xyz") for _ in range(rng.randint(1, 9))]
            words += block * rng.randint(1, 12) + ["stop"] * rng.randint(0, 2)
        rows.append((i, "  ".join(words) + "\n"))
    return rows


def test_periodic_runs_equal_brute_force(spark, documents):
    rows = periodic_texts(4) + [r for r in ODD if r[0] != 7]
    found = periodic.digest(periodic.periodic_runs(documents(rows), alter=periodic.echoed)).collect()
    assert Counter(map(tuple, found)) == Counter(brute_document(*r) for r in rows)
    assert sum(r["n_runs"] for r in found) > 50


def test_periodic_runs_keep_texts_and_spans(spark, documents):
    lines = "one two three four five six seven eight nine ten. " * 4
    rows = periodic.periodic_runs(documents([(7, "word " * 30_000), (8, lines + "end"), (9, None)])).orderBy("doc_id").collect()
    assert [r["collapsed"] for r in rows] == ["word", lines[:len(lines) // 4] + "end", ""]
    assert [[tuple(x) for x in r["runs"]] for r in rows] == [[(0, 30_000, 1)], [(0, 40, 10)], []]
    assert periodic.digest(periodic.periodic_runs(documents([]))).count() == 0


# -- SimHash

def brute_fingerprint(text, k=4):
    from xxhash import xxh64_intdigest
    words = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_links(fps, errors, same=lambda i, j: True):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if same(i, j) and bin(fps[i] ^ fps[j]).count("1") <= errors:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near_fingerprints(rng, n, bits):
    out = set()
    for _ in range(n):
        x = rng.getrandbits(bits)
        if out and rng.random() < 0.7:
            x = rng.choice(sorted(out))
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(bits)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("seed", range(40))
def test_trie_links_equal_all_pairs(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(simhash, "DIRECT", rng.choice([1, 4, 32]))
    monkeypatch.setattr(simhash, "FRONTIER", rng.choice([4, 1 << 16]))
    fps = near_fingerprints(rng, rng.randint(1, 120), rng.choice([8, 12, 64]))
    tree = sorted(rng.randrange(rng.choice([1, 3])) for _ in fps)
    fps = [f for _, f in sorted(zip(tree, fps))]
    errors = rng.choice([0, 1, 2, 4])
    got = simhash.trie_links(np.array(fps, "u8"), np.array(tree), np.arange(len(fps)), 64, errors)
    assert got.tolist() == brute_links(fps, errors, lambda i, j: tree[i] == tree[j])


def test_every_linked_pair_shares_a_subtrie():
    rng = random.Random(5)
    for blocks in simhash.BLOCKS:
        orders = simhash.bit_orders(blocks, 4)
        for _ in range(20):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(range(64), 4):
                y ^= 1 << b
            pair = np.array([x, y], "u8")
            tops = [simhash.reordered(pair, moves) >> np.uint64(64 - width) for width, moves in orders]
            assert any(t[0] == t[1] for t in tops)
            assert all((simhash.reordered(simhash.reordered(pair, m), m, back=True) == pair).all() for _, m in orders)


@pytest.mark.parametrize("limit", [simhash.LIMIT, 3])
def test_linked_fingerprints_with_large_subtries(spark, limit):
    """With a low limit the large subtries go through the finer orders."""
    rng = random.Random(6)
    fps = near_fingerprints(rng, 60, 64)
    middle = rng.getrandbits(64)
    for _ in range(80):
        y = middle
        for _ in range(rng.randint(1, 5)):
            y ^= 1 << rng.randrange(64)
        fps.append(y)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["node"]: r["root"] for r in simhash.linked_fingerprints(table, 4, limit).collect()}
    want = brute_links(fps, 4)
    groups = Counter(want)
    assert set(got) == {f for f, r in zip(signed, want) if groups[r] > 1}
    assert len({(got[f], r) for f, r in zip(signed, want) if f in got}) == len(set(got.values()))
    assert len(set(got.values())) == sum(n > 1 for n in groups.values())


def test_simhash_equals_brute_force(spark, documents):
    rng = random.Random(8)
    rows = list(ODD) + [(9, "  "), (10, "a b"), (11, "A  b"), (12, "a b c d")]
    for i in range(20, 140):
        if rng.random() < 0.6 and i > 20:
            words = rng.choice(rows[14:])[1].split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice("pqr")
        else:
            words = [rng.choice("abcdefgh") + str(rng.randrange(90)) for _ in range(rng.randint(40, 200))]
        rows.append((i, " ".join(words)))
    fps = [brute_fingerprint(t) for _, t in rows]
    root = brute_links(fps, 4)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = Counter((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root))
    assert Counter(map(tuple, simhash.near_duplicates(documents(rows)).collect())) == want
    assert len(set(root)) < len(set(fps)) - 10
    assert simhash.near_duplicates(documents([])).count() == 0


def test_fingerprint_of_many_shingles_in_runs(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(300))
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    assert simhash.fingerprint(text.encode().split(), 4) == brute_fingerprint(text)


# -- spelling variants

def one_apart(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return any(y[:i] + y[i + 1:] == x for i in range(len(y)))


@settings(max_examples=300, deadline=None)
@given(st.text("abé", max_size=5), st.text("abé", max_size=5))
def test_near_is_one_edit(x, y):
    assert variants.near(x, y) == one_apart(x, y)


def brute_words(rows, letters=7, least=2):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= least}


def brute_variants(words, times=10):
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return Counter((w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words)


def typed_words(rng, n):
    """Words and what becomes of them under up to three edits."""
    out = {}
    for _ in range(n):
        w = rng.choice(sorted(out)) if out and rng.random() < 0.7 else "".join(rng.choice("aeinrst") for _ in range(rng.randint(7, 9)))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("aeépq") + w[at:], w[:at] + rng.choice("aeé") + w[at + 1:]])
        out[w] = rng.choice([2, 3, 25, 400, 9000])
    return out


@pytest.mark.parametrize("limit,depth", [(variants.LIMIT, None), (variants.LIMIT, 4), (1, 3), (20, 16), (2, 0)])
def test_variants_equal_brute_force(spark, limit, depth):
    rng = random.Random(9)
    words = typed_words(rng, 250)
    words |= {"a" * 14: 5, "a" * 15: 60, "a" * 16: 700, "a" * 17: 8000, "a" * 15 + "b": 3, "a" * 16 + "b": 2, "x" * 5000: 3,
              "x" * 5001: 40}
    table = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = variants.variants(table, limit=limit, depth=depth).collect()
    assert Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got) == brute_variants(words)


def test_large_leaves_are_found_by_index(spark, monkeypatch):
    rng = random.Random(10)
    words = {"".join(rng.sample("aeinrst", 7)) + rng.choice("xhb"): rng.randint(2, 50) for _ in range(120)}
    rows = list(words)
    leaf = variants.Leaf(list(range(len(rows))), rows)
    monkeypatch.setattr(variants, "LARGE_LEAF", 1)
    indexed = variants.Leaf(list(range(len(rows))), rows)
    for w in rows:
        assert ({r for r in leaf.candidates(w) if variants.near(w, rows[r])}
                == {r for r in indexed.candidates(w) if variants.near(w, rows[r])})


def test_words_of_documents(spark, documents):
    rng = random.Random(11)
    vocabulary = ["Straßen", "ÉCLAIRS", "éclairs", "wandering", "wanderingg", "short", "naïveté", "x×y÷zzz"]
    rows = list(ODD) + [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for i in range(100, 400)]
    table = documents(rows)
    got = variants.count_words(table, alter=variants.distorted)
    words = brute_words(rows)
    assert {r["word"]: r["n"] for r in got.collect()} == words
    assert any(w not in [v.lower() for v in vocabulary] for w in words)
    found = variants.variants(got).collect()
    assert Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found) == brute_variants(words)
    assert variants.variants(variants.count_words(documents([]))).count() == 0
