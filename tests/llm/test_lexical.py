import math
import random
import re

import duckdb
import numpy as np
import pytest

from cadenza.llm import lexical as lx


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lx.TERM, low)


def plain(documents, items, k=10):
    """documents: (doc_id, text); items: (item_id, text)."""
    docs = [(i, plain_terms(t)) for i, t in documents]
    docs = [(i, t) for i, t in docs if t]
    n, total = len(docs), sum(len(t) for _, t in docs)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(plain_terms(text))
    df = {t: sum(t in d for _, d in docs) for t in set().union(*wanted.values())} if wanted else {}
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    rows = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, words in docs:
            m = 10 + 90 * len(words) * n // total
            score = sum(
                weight[t] * (10**9 * words.count(t) // (1000 * words.count(t) + 8 * m))
                for t in terms if t in words
            )
            if score > 0:
                scored.append((-score, (doc_id is not None, doc_id or 0), doc_id))
        scored.sort(key=lambda s: s[:2])
        rows += [(item, r, d, -s) for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(rows, key=str)


def found(spark, path, k=10):
    read = spark.read.parquet
    df = lx.search(read(f"{path}/documents.parquet"), read(f"{path}/benchmark.parquet"), k)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def texts(rng, n, most):
    words = [f"w{k}" for k in range(40)] + ["Über", "naïve", "你好", "\U0001f600", "X9"]
    weights = [1 / (k + 1) for k in range(len(words))]
    joins = [" ", ", ", "-", "\n", "\x00", "_"]
    out = []
    for _ in range(n):
        some = rng.choices(words, weights, k=rng.randrange(1, most))
        out.append("".join(w + rng.choice(joins) for w in some))
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lx, "BLOCK_POSTINGS", 60)


def test_equals_plain_ranking(spark, written, small_blocks):
    rng = random.Random(1)
    docs = list(enumerate(texts(rng, 120, 60)))
    docs += [(500 + k, docs[7][1]) for k in range(15)]  # ties
    rng.shuffle(docs)
    items = list(enumerate(texts(rng, 12, 14)))
    path = written(documents=(docs, "doc_id long, text string"),
                   benchmark=(items, "item_id long, text string"))
    for k in (10, 3, 25):  # 25 lies beyond the stored depth
        assert found(spark, path, k) == plain(docs, items, k)


def test_groups_of_items_change_nothing(spark, written, monkeypatch):
    rng = random.Random(2)
    docs, items = list(enumerate(texts(rng, 40, 30))), list(enumerate(texts(rng, 9, 9)))
    path = written(documents=(docs, "doc_id long, text string"),
                   benchmark=(items, "item_id long, text string"))
    monkeypatch.setattr(lx, "MOST_TERMS", 10)
    assert found(spark, path) == plain(docs, items)


def test_cases(spark, written):
    docs = [(1, "a b c"), (2, None), (3, ""), (None, "a b"), (1, "a b c"), (4, " .,; "), (None, "c"),
            (5, "A " * 3000 + "b"), (6, "d e")]
    items = [(1, "a, B"), (1, "c"), (2, None), (3, "unknown"), (None, "c a"), (4, ""), (1, "a, B")]
    clash = [(*d, 1, "x", 2) for d in docs]
    path = written(
        documents=(clash, "doc_id long, text string, n long, terms string, score long"),
        benchmark=([(*i, 7, "x") for i in items], "item_id long, text string, rank int, term string"),
    )
    assert found(spark, path) == plain(docs, items)


def test_empty_tables(spark, written, tmp_path):
    docs, items = [(1, "a")], [(1, "a")]
    schema = "doc_id long, text string", "item_id string, text string"
    path = written(documents=([], schema[0]), benchmark=([("1", "a")], schema[1]))
    assert found(spark, path) == []
    other = spark.createDataFrame(docs, schema[0])
    assert lx.search(other, spark.createDataFrame([], schema[1])).collect() == []


def test_a_long_text_comes_in_parts(spark, written, monkeypatch):
    from cadenza.llm import common

    rng = random.Random(4)
    docs, items = list(enumerate(texts(rng, 3, 400))), list(enumerate(texts(rng, 3, 9)))
    path = written(documents=(docs, "doc_id long, text string"),
                   benchmark=(items, "item_id long, text string"))
    monkeypatch.setattr(common.cut_slices, "__defaults__", (50,))
    parts = list(common.cut_slices(__import__("pyarrow").array([docs[0][1]]), ~lx._IN_TERM))
    assert b"".join(p[1].tobytes() for p in parts).decode() == docs[0][1]
    assert found(spark, path) == plain(docs, items)


def test_pair_bounds_look_at_fewer_documents():
    """Two rare terms that never meet: their joint bound is one term's, not the sum."""
    size = 400
    terms = [[0] if d % 2 else [1] for d in range(size - 20)] + [[0, 1, 2]] * 20
    docs = np.repeat(np.arange(size), [len(t) for t in terms])
    flat = np.concatenate(terms)
    items = lx.Items(["i"], [np.array([0, 1, 2])], np.arange(3).astype(np.uint64))
    counts = np.ones(len(flat), np.int64)
    ranking = lx.Ranking(size, size, np.array([500, 400, 300]), np.array([[0, 1]]), [[(0, -1), (-1, 2)]])
    block = lx.Block.build(ranking, np.arange(size), np.ones(size, np.int64), docs, flat, counts)
    single = [(-1, 0), (-1, 1), (-1, 2)]
    least = int(block.most[[0, 1, 2]].sum())
    got, scores, looked = block.top(ranking, ranking.units[0], 10, least)
    same, others, all_looked = block.top(ranking, single, 10, least)
    assert got.tolist() == same.tolist() and scores.tolist() == others.tolist() and len(got) == 20
    assert looked == 20 and looked <= all_looked


def test_large_numbers_do_not_overflow():
    ranking = lx.Ranking(10**12, 10**15, np.array([60000]))
    got = ranking.impacts(np.array([0, 0]), np.array([5, 10**6]), np.array([10**7, 10**9]))
    want = [
        60000 * (10**9 * tf // (1000 * tf + 8 * (10 + 90 * n * 10**12 // 10**15)))
        for tf, n in ((5, 10**7), (10**6, 10**9))
    ]
    assert got.tolist() == want


def test_sql_counterpart(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as from '{path}/{name}.parquet'")
    want = sorted(con.sql(f"select item_id, rank, doc_id, score from ({lx.ORACLE})").fetchall(), key=str)
    assert found(spark, path) == want
