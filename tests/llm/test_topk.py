import numpy as np
import pytest

from cadenza.llm import topk


def plain(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good[i] = np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)
    out = []
    for q in sorted(i for i in good if i % 50 == 0):
        found = [(-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("block", [32, 1 << 14])
def test_equals_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(230)]
    rows += [(300 + i, rows[50][1]) for i in range(40)]  # ties
    rows += [(400, [0.0] * 8), (450, [1.5, -2.0, None] + [0.0] * 5), (451, None), (452, [float("nan")] * 8),
             (453, [float("inf")] + [0.0] * 7), (500, [0.1, -0.2]), (501, [0.3, 0.3]), (550, []),
             (None, [0.1] * 8), (600, [3.0] * 8), (600, [3.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search(df.selectExpr("*", "1 as width", "2 as score"), "vec_id % 50 = 0", 5).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain(rows))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, "vec_id % 50 = 0", 5).count() == 0


def test_bitmap_sums_are_exact():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-60, 60, (200, 6))
    index = topk.Index(np.arange(200), vectors)
    query = np.array([3, -7, 0, 12, -1, 100])
    slices = index.sums(query)
    bits = np.unpackbits(slices.view(np.uint8), axis=1, bitorder="little")[:, :200].astype(np.int64)
    got = (bits << np.arange(len(bits))[:, None]).sum(0)
    above = vectors - vectors.min(0)
    weight = np.where(query < 0, 127 - above, above)
    assert index.shift == 0 and (got == (weight * np.abs(query)).sum(1)).all()
