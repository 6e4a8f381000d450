import random

import corpus_pipeline
from cadenza.llm import toxicity

from .test_jaccard import expected as groups
from .test_secrets import base

INSULTS = "idiot moron pathetic worthless scum".split()


def plain(rows, toxic, items):
    """The stages one after another, in Python."""
    rows = [r for r in rows if r[0] not in toxic]
    keepers, kept = set(), []
    for (i, text), (_, n, component) in zip(rows, groups(rows)):
        if not n or i == component and i not in keepers:
            keepers.add(i)
            kept.append((i, text))
    kept = [r for r in kept if not any(item in (r[1] or "") for item in items)]
    out = []
    for i, text in kept:
        text, clean, at = text or "", "", 0
        for start, kind, end in sorted(base(text)[0]):
            if start >= at:  # else it overlaps the one before
                clean += text[at:start] + f"[{('assign', 'access', 'hex')[kind]}]"
            at = max(at, end)
        out.append((i, clean + text[at:]))
    return sorted(out)


def test_pipeline_equals_plain_stages(spark, written):
    rng = random.Random(9)
    words = ["".join(rng.choices("aeioulmnrst", k=rng.randrange(2, 8))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choices(words, k=n))

    items = [text(20) for _ in range(3)]
    rows = [text(rng.randrange(30, 80)) for _ in range(120)]
    rows += [f"{text(20)} {' '.join(rng.choices(INSULTS, k=4))} {text(10)}" for _ in range(60)]
    rows += [f"{rows[k]} more" for k in range(10)] + [rows[0], None, "", "   "]
    rows += [f"{text(30)} {items[k % 3]} {text(9)}" for k in range(6)]
    rows += [f'{text(25)} token = "{"0f1e2d3c" * 5}" {text(9)}' for _ in range(5)]
    rows = list(enumerate(rows))
    labels = [(i, 1, int(120 <= i < 180)) for i, _ in rows if i < 180]
    folder = written(
        documents=(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        ),
        labels=(labels, "doc_id long, quality int, toxic int"),
        benchmark=(list(enumerate(items)), "item_id long, text string"),
    )
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scores = toxicity.scored(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    toxic = {r.doc_id for r in scores if r.score >= toxicity.THRESHOLD}
    assert toxic == set(range(120, 180))
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "ids", "text"]
    found = got.collect()
    assert sorted((r.doc_id, r.text) for r in found) == plain(rows, toxic, items)
    assert all(bool(r.ids) == bool(r.text) for r in found)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
