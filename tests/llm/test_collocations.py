import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from cadenza.llm import collocations as co


def plain(documents, least, longest=4, top=2000):
    """documents: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in documents:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    rows = {}
    for (lang, *w), a in candidates.items():
        covered = any(
            q[0] == lang and len(q) > len(w) + 1 and 100 * b >= 80 * a
            and any(list(q[i : i + len(w)]) == w for i in range(1, len(q) - len(w) + 1))
            for q, b in candidates.items()
        )
        if covered:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, some in rows.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1)
    )


def found(docs, **how):
    df = co.collocations(docs, **how)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(map(tuple, df.collect()))


def corpus(rng, n):
    words = [f"w{k}" for k in range(12)] + ["Über", "naïve", "你好", "\U0001f600", "x y", "'a'"]
    runs = ["New York City", "the end of the", "a a a a a", "été à la"]
    joins = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "! "]
    out = []
    for _ in range(n):
        parts = rng.choices(words + runs * 3, k=rng.randrange(0, 25))
        text = "".join(w + rng.choice(joins) for w in parts)
        out.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return out


@pytest.fixture
def tiny(monkeypatch):
    """Containers burst and tries spill all the time."""
    monkeypatch.setattr(co, "BURST", 4)
    monkeypatch.setattr(co, "MOST_KEYS", 40)
    monkeypatch.setattr(co, "LEAST_PARTS", 3)


def test_equals_plain_counting(spark, tiny):
    docs = corpus(random.Random(1), 250)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    assert found(df, least=5) == plain(docs, 5)
    assert found(df, least=8, top=3) == plain(docs, 8, top=3)


def test_other_lengths(spark):
    docs = corpus(random.Random(2), 120)
    df = spark.createDataFrame(docs, "text string, lang string")
    for longest in (2, 3, 5):
        assert found(df, least=4, longest=longest) == plain(docs, 4, longest)


def test_cases(spark, tiny):
    docs = [(None, "en"), ("", "en"), ("a b a b a b", "en"), (" .,;\n", None), ("a b", None)] * 3
    rows = [(*d, 1, "x", 2, 3) for d in docs]
    df = spark.createDataFrame(
        rows, "text string, lang string, id long, words string, f int, part int"
    )
    assert found(df, least=2) == plain(docs, 2)
    assert found(df.limit(0), least=1) == []
    assert found(df, least=100) == []


def test_full_filters_lose_nothing(spark, monkeypatch):
    docs = corpus(random.Random(3), 100)
    df = spark.createDataFrame(docs, "text string, lang string")
    monkeypatch.setattr(co, "LEAST_BITS", 256)
    monkeypatch.setattr(co, "MOST_BITS", 256)
    assert found(df, least=4) == plain(docs, 4)


def test_trie_counts_bursts_and_spills(monkeypatch):
    monkeypatch.setattr(co, "BURST", 16)
    monkeypatch.setattr(co, "MOST_KEYS", 300)
    rng = np.random.default_rng(4)
    trie, want, got, nodes = co.Trie(3), Counter(), Counter(), 0
    for _ in range(60):
        keys = (rng.zipf(1.5, (50, 3)) % 60 + 1).astype(np.uint64)
        keys[:, 0] %= np.uint64(2)
        keys = np.unique(keys, axis=0)
        counts = rng.integers(1, 9, len(keys))
        want.update(dict(zip(map(tuple, keys.tolist()), counts.tolist())))
        for run in trie.add(keys, counts):
            got.update(dict(zip(map(tuple, run[0].tolist()), run[1].tolist())))
        nodes += any(isinstance(c, co.Node) for c in trie.root.children)

        def ranges(node, prefix):
            for k, child in enumerate(node.children):
                if isinstance(child, co.Node):
                    ranges(child, prefix + ([None] if child.one else []))
                elif len(child.all()[1]) and not node.one:
                    ids = child.keys[:, node.level]
                    assert (ids >= node.lows[k]).all()
                    assert k + 1 == len(node.lows) or (ids < node.lows[k + 1]).all()

        ranges(trie.root, [])
        assert trie.root.size <= 300 + 50
    for run in trie.spill(0):
        got.update(dict(zip(map(tuple, run[0].tolist()), run[1].tolist())))
    assert got == want and nodes and trie.root.size == 0


def test_large_numbers_stay_exact(spark):
    big = 5 * 10**15
    rows = [(1, [1], 9 * big), (1, [2], 9 * big), (1, [1, 2], big)]
    phrases = spark.createDataFrame(rows, "lang long, words array<long>, f long")
    assert [r.score for r in co.scored(phrases).collect()] == [2_000_000 * big // (18 * big)]


def test_sql_counterpart(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as from '{path}/documents.parquet'")
    want = sorted(con.sql(co.ORACLE).fetchall())
    assert len(want) > 100
    assert found(spark.read.parquet(f"{path}/documents.parquet")) == want
