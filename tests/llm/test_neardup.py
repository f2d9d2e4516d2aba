"""Near duplicates against all pairs of a small table."""

import random

import numpy as np
from edges import TEXTS, documents, table

from tidemark.llm import neardup


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(texts):
    """doc -> smallest linked doc, by comparing all pairs."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(texts)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in texts}


def copies(seed=5):
    """A passage that all texts share, a chain of edited copies, and copies of one base."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = " ".join(word() for _ in range(25))
    texts = {i: f"{shared} " + " ".join(word() for _ in range(60)) for i in range(60)}
    chain = [word() for _ in range(120)]
    for i in range(100, 130):
        texts[i] = " ".join(chain)
        chain[rng.randrange(len(chain))] = word()
    base = [word() for _ in range(150)]
    for i in range(200, 260):
        edited = list(base)
        for _ in range(3):
            edited[rng.randrange(len(edited))] = word()
        texts[i] = " ".join(edited)
    return texts


def test_chains_stars_and_shared_passages(spark):
    texts = copies()
    expected = brute(texts)
    rows = neardup.near_duplicates(documents(spark, list(texts.items()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    kept = neardup.keep_one(documents(spark, list(texts.items()))).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in expected.values()})


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = neardup.near_duplicates(table(spark, "documents")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)


def test_edges(spark):
    rows = neardup.near_duplicates(documents(spark)).collect()
    assert len(rows) == len(TEXTS)
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in rows)
    assert found == sorted(
        [
            ("1", 7, "1", True), ("1", 7, "1", True), ("2", 7, "1", False), ("3", 0, "3", True), ("None", 6, "None", True),
            ("None", 0, "None", True), ("4", 0, "4", True), ("5", 0, "5", True), ("6", 4, "6", True), ("7", 1, "7", True), ("8", 1, "8", True),
        ]
    )
    kept = neardup.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "8", "None", "None"]
    assert neardup.near_duplicates(documents(spark, [])).count() == 0
    assert neardup.keep_one(documents(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for n in (4, 40, 400, 4000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate((a[: n // 2], rng.integers(0, 1 << 63, n - n // 2, dtype=np.uint64)))
        x, y = neardup.superminhash([np.sort(a), np.sort(b)])
        errors.append(abs((x == y).mean() - 1 / 3))
        assert (x == neardup.superminhash([rng.permutation(a)])[0]).all()
        assert len(np.unique(x)) <= 128 and (x != np.iinfo(np.uint64).max).all()
    assert max(errors) < 0.2 and np.mean(errors) < 0.1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (502, 501)], "a long, b long")
    found = {r.node: r.label for r in neardup.components(edges.repartition(7)).collect()}
    assert found == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}


def test_many_texts_without_an_id(spark):
    """Pairs of near copies without ids; each set is looked up by its own text."""
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        rows += [(None, " ".join(words)), (None, " ".join([*words, f"end{i}"]))]
    assert neardup.keep_one(documents(spark, rows)).count() == 1500
