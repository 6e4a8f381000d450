import collections
import hashlib
import random
import re

from cadenza.llm import repeats

W = repeats.WINDOW


def expected(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = collections.Counter(
        tuple(w[i : i + W]) for w in words for i in range(len(w) - W + 1)
    )
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - W + 1):
            if count[tuple(w[i : i + W])] > 1:
                gone.update(range(i, i + W))
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(text.encode()).hexdigest()))
    return out


def corpus():
    rng = random.Random(2)
    words = [f"Wort{k}" for k in range(300)] + ["é", "x", "y"]

    def text(n):
        return rng.choices(words, k=n)

    rows = []
    passages = [text(n) for n in (35, 36, 50, 90, 200)]
    for _ in range(60):
        parts = text(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, b = sorted(rng.choices(range(len(p) + 1), k=2))
            parts += p[a:b] if rng.random() < 0.5 else p
            parts += text(rng.randrange(30))
        rows.append(" ".join(parts))
    once = text(40)
    rows.append(" ".join([*once, "mid", *once]))  # repeats within one document
    rows += ["a " * 200, "a b " * 90, " ".join(text(34)), None, "", " \t\n", rows[0], rows[0]]
    rows.append(" ".join(text(3_000) + passages[4] + text(3_000)))
    return list(enumerate(rows)) + [(None, rows[5]), (3, "x " * 40), (None, None), (None, rows[5])]


def order(row):
    return tuple((v is None, v) for v in row)


def test_equals_counting_all_windows(spark, documents):
    rows = corpus()
    docs = repeats.whole_texts(documents(*rows))
    got = [tuple(r) for r in repeats._kept(docs, digest=True).collect()]
    assert sorted(got, key=order) == sorted(expected(rows), key=order)
    texts = repeats.kept(docs).collect()
    digests = [hashlib.sha256(r.text.encode()).hexdigest() for r in texts]
    assert sorted(digests) == sorted(r[3] for r in expected(rows))


def test_empty_table(spark, documents):
    docs = repeats.whole_texts(documents((1, "a")).where("false"))
    assert repeats.kept(docs).count() == 0
