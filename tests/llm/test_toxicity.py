import tracemalloc

import numpy as np
import pyarrow as pa

from cadenza.llm import common, jaccard
from cadenza.llm import toxicity as tx
from cadenza.llm.common import table

GIVEN = "/root/testdata/sf0.1"  # sf0.01 has a dozen toxic documents to hold out


def test_held_out_accuracy(spark):
    got = tx.op4(spark, GIVEN)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    marked = got.join(table(spark, GIVEN, "labels"), "doc_id").where("held_out").toPandas()
    bad, good = marked[marked.toxic == 1].score, marked[marked.toxic == 0].score
    assert (bad.values[:, None] > good.values[None, :]).mean() > 0.85
    assert (marked.predicted == marked.toxic).mean() > 0.9


def test_label_model_finds_accuracies_and_correlation():
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.3
    a = rng.random(n) < np.where(y, 0.7, 0.05)
    b = np.where(rng.random(n) < 0.9, a, rng.random(n) < 0.2)  # repeats a
    c = rng.random(n) < np.where(y, 0.6, 0.1)
    bits = a + 2 * b + 4 * c
    label = np.where(rng.random(n) < 0.1, y, -1)
    keys, count = np.unique(np.stack([bits, label]), axis=1, return_counts=True)
    model = tx.LabelModel(keys[0].astype(np.int64), keys[1], count)
    assert abs(model.rates[1][0] - 0.6) < 0.15 and model.rates[0][0] < 0.15
    assert model.correlation[0, 1] > 0.5 > abs(model.correlation[0, 2])
    p = model.posterior(np.array([0, 4, 5, 7]))
    # b depends on a alone: once a fired it tells nothing more about the class.
    assert p[0] < p[1] < p[2] and abs(p[3] - p[2]) < 0.05


def test_cases(spark, documents):
    docs = documents(
        (1, "you pathetic idiot, worthless idiot"), (2, None), (2, None), (None, ""),
        (3, "fine words " * 30_000), (4, "An ordinary sentence."),
    )
    labels = spark.createDataFrame([(None, 1), (9, None)], "doc_id long, toxic int")
    rows = tx.scored(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, None)}) == 1
    assert tx.scored(docs.where("false"), labels).count() == 0


def test_votes_by_place():
    text = "Idiot idiot. f*ck LOUD WORDS ARE SHOUTED HERE"
    data = np.frombuffer(text.encode(), np.uint8)
    voters = tx.Voters(np.zeros(0, np.uint64))
    (bits,) = voters.votes(data, tx.Tokens.of(data, np.array([0, len(data)])))
    fired = {v for k, v in enumerate(tx.VOTERS) if bits >> k & 1}
    assert fired == {"intellect", "masked", "shouting", "twice", "dense"}


def test_a_task_gives_its_memory_back(monkeypatch):
    done = []

    class Library:
        def malloc_trim(self, pad):
            done.append(pad)

    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: Library())
    rows = common.tidy(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert next(rows) == 2 and not done
    assert list(rows) == [4] and done == [0]


def test_a_task_holds_little_of_a_batch(monkeypatch):
    """Both first stages of the pipeline work on small slices of the 4 MB that a batch may have."""
    rng = np.random.default_rng(3)
    words = np.array(["idiot", "plain", "somewhat", "longer", "sentences", "here"])
    texts = [" ".join(rng.choice(words, 300)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], ["doc_id", "text"])

    class Given:
        def mapInArrow(self, work, schema):
            tracemalloc.start()
            found = sum(b.num_rows for b in work(iter([batch])))
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            return found, peak

    monkeypatch.setattr(tx, "whole_texts", lambda documents: documents)
    found, peak = tx.votes_of(Given(), tx.Voters(np.zeros(0, np.uint64)))
    assert found == 2000 and peak < 60e6
    found, peak = jaccard.profiles(Given())
    assert found == 2000 and peak < 60e6
