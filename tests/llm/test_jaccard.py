import itertools
import random
import re
from collections import Counter

import numpy as np

from cadenza.llm import jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[root(i)] = min(key, ids.get(root(i), key))
    return [(key, len(sets[i]), ids.get(root(i))) for i, (key, _) in enumerate(rows)]


def corpus():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]

    def text(n):
        return rng.choices(words, k=n)

    rows = []
    for size, copies, edits in ((60, 60, 3), (90, 12, 4), (40, 5, 1), (25, 30, 1)):
        base = text(size)
        for _ in range(copies):
            other = list(base)
            for _ in range(rng.randrange(edits + 1)):
                other[rng.randrange(size)] = rng.choice(words)
            rows.append(" ".join(other))
    passage = text(30)
    rows += [" ".join(text(rng.randrange(0, 12)) + passage + text(rng.randrange(0, 12))) for _ in range(40)]
    rows += [" ".join(text(50)) for _ in range(30)] + ["One two", "one TWO", "one two three", None, "", "  \n"]
    rows += [rows[0]] * 20 + [("long " + " ".join(text(4_000)))] * 2
    rng.shuffle(rows)
    return [(k, t) for k, t in enumerate(rows)] + [(None, rows[0]), (None, "alone here now"), (3, "x")]


def key(row):
    return tuple((v is None, v) for v in row)


def test_groups_equal_all_pairs(spark, documents):
    rows = corpus()
    got = jaccard.grouped(documents(*rows))
    got = [tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_long_lists_lose_no_link(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 8)  # several blocks a list
    monkeypatch.setattr(jaccard, "sketch", lambda texts: _levels())
    rows = corpus()
    got = jaccard.grouped(documents(*rows))
    got = [tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_signatures_rule_out_no_link():
    rng = np.random.default_rng(3)
    for size in (1, 7, 60, 300, 5_000):
        x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        for edits in (0, 1, size // 9, size // 8, size // 7, size // 4, size):
            y = np.unique(np.concatenate([x[edits:], rng.integers(0, 1 << 63, edits).astype(np.uint64)]))
            raw = [jaccard.signature(s) for s in (x, y)]
            n = np.array([len(x) + len(y)])
            able = jaccard.Signatures(raw).allow(np.array([0]), np.array([1]), n)[0]
            both = len(np.intersect1d(x, y))
            assert able or 4 * both < 3 * (n[0] - both)
            if edits == size and 20 < size <= 300:
                assert not able


def test_passage_of_thousands_of_different_documents():
    """Documents that share a passage but are no near copies: few pairs leave a block."""
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 1 << 63, 70).astype(np.uint64)
    sets = [np.concatenate([passage, rng.integers(0, 1 << 63, 40).astype(np.uint64)]) for _ in range(1_500)]
    sets.append(np.concatenate([sets[0][:-3], passage[:1] + np.uint64(1)]))
    n = np.array([len(s) for s in sets])
    node = np.arange(len(sets))
    meta = jaccard._packed(n, np.ones(len(sets), int), np.ones(len(sets), int))
    zero = np.zeros(len(sets), int)
    blocks = jaccard.Blocks()
    rows = np.stack([zero, zero, zero, zero, node, node, meta])
    rest, _ = blocks.take(rows, [jaccard.signature(s) for s in sets], True)
    found = np.hstack(blocks.found)
    pairs = set(zip(found[0].tolist(), found[1].tolist()))
    assert rest.shape[1] == 0 and (0, 1_500) in pairs and len(pairs) < 1_500


def test_near_copies_of_one_list_give_one_pair_each():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 120).astype(np.uint64)
    sets = [base]
    for _ in range(800):
        sets.append(np.concatenate([base[rng.integers(5, 20) :], rng.integers(0, 1 << 63, 5).astype(np.uint64)]))
    n = np.array([len(s) for s in sets])
    node, zero, one = np.arange(len(sets)), np.zeros(len(sets), int), np.ones(len(sets), int)
    blocks = jaccard.Blocks(hubs=True)
    rows = np.stack([zero, zero, zero, zero, node, node, jaccard._packed(n, one, one)])
    blocks.take(rows, [jaccard.signature(s) for s in sets], True)
    a, b, _ = np.hstack(blocks.found)
    assert len(a) <= len(sets) and set(a.tolist()) | set(b.tolist()) == set(range(len(sets)))


def test_pair_of_many_long_lists_comes_few_times(spark):
    rng = np.random.default_rng(7)
    tokens = rng.integers(-(1 << 63), (1 << 63) - 1, 60)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    signed = jaccard.signature(base)
    meta = int(jaccard._packed(np.array([300]), np.array([1]), np.array([50_000]))[0])
    late = int(jaccard._packed(np.array([300]), np.array([40_000]), np.array([50_000]))[0])
    rows = [
        (int(t), node, late if rng.random() < 0.2 else meta)
        for node in range(40) for t in tokens[rng.random(60) < 0.8]
    ]
    long = spark.createDataFrame(rows, "token long, node long, meta long")
    labels = spark.createDataFrame([], "node long, component long")
    profile = spark.createDataFrame([(k, bytearray(signed)) for k in range(40)], "node long, short binary")
    found = [(r.a, r.b) for r in jaccard.crossing(long, labels, profile).collect()]
    size = np.array(list(Counter(t for t, _, _ in rows).values()))
    assert set(found) == set(itertools.combinations(range(40), 2))
    assert len(found) < (size * (size - 1) // 2).sum() / 4


def test_long_documents_of_one_passage_are_ruled_out_in_their_list(spark, documents):
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(1_500 + k))) for k in range(30)]
    found = jaccard.profiles(documents(*rows).select("doc_id", "text")).collect()
    n, zero, one = np.array([r.n for r in found]), np.zeros(30, int), np.ones(30, int)
    blocks = jaccard.Blocks()
    lists = np.stack([zero, zero, zero, zero, np.arange(30), np.arange(30), jaccard._packed(n, one, one)])
    blocks.take(lists, [bytes(r.short) for r in found], True)
    assert sum(f.shape[1] for f in blocks.found) == 0


def _levels():
    return np.random.default_rng(1).integers(0, 4, 1 << jaccard.SKETCH_BITS).astype(np.uint8)


def test_stage_keeps_one_of_each_group(spark, documents):
    rows = corpus()
    docs = documents(*rows)
    kept = jaccard.stage(spark, docs, "")
    assert kept.columns == docs.columns
    groups = {}
    for (k, t), (_, n, component) in zip(rows, expected(rows)):
        groups.setdefault(component if n else (k, t), []).append((k, t))
    by_text = {t for _, t in rows}
    found = [(r.doc_id, r.text) for r in kept.collect()]
    empty = [r for r in rows if not shingles(r[1])]
    assert sum(not shingles(t) for _, t in found) == len(empty)
    alone = {(None, "alone here now")}
    full = {r[0] for r in found if shingles(r[1])} - {None}
    assert full == {c for _, n, c in expected(rows) if n and c is not None}
    assert alone <= set(found) and all(t in by_text for _, t in found)


def test_empty_table(spark, documents):
    docs = documents((1, "a")).where("false")
    assert jaccard.grouped(docs).count() == 0 and jaccard.stage(spark, docs, "").count() == 0
