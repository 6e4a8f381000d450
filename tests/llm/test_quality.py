import numpy as np

from cadenza.llm import quality
from cadenza.llm.common import table

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = quality.op10(spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    marked = got.join(table(spark, SMALL, "labels"), "doc_id").where("held_out").toPandas()
    good, bad = marked[marked.quality == 1].score, marked[marked.quality == 0].score
    above = (good.values[:, None] > bad.values[None, :]).mean()
    assert above > 0.9
    assert (marked.predicted == marked.quality).mean() >= marked.quality.mean()


def test_context_sums_equal_a_plain_count(spark, documents):
    texts = ["the cat, the dog", "", None, "cat cat"]
    found = quality.contexts(documents(*enumerate(texts)))
    place, sign = quality._places()
    plain = np.zeros_like(found)
    for text in texts:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        b = quality._buckets(quality.Words.runs(raw, np.array([0, len(raw)])))
        for i, word in enumerate(b):
            plain[word, quality.DIMS] += 1
            for j in range(max(0, i - quality.REACH), min(len(b), i + quality.REACH + 1)):
                for k in range(quality.NONZERO) if i != j else ():
                    plain[word, place[b[j], k]] += sign[b[j], k]
    assert np.allclose(found, plain)


def test_cases(spark, documents):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, quality int"
    )
    docs = documents((1, "good text"), (2, None), (2, None), (None, ""), (4, "a " * 50_000))
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, None)}) == 1
    none = quality.scored(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.scored(docs.where("false"), labels).count() == 0
