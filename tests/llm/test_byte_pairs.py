import gc
import hashlib
import random

import numpy as np
import pytest
import tiktoken

from cadenza.llm import byte_pairs as bp

RANKS, PATTERN = bp.default_files()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bp.read_ranks(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def model():
    return bp.BytePairs(bp.read_ranks(RANKS), PATTERN)


def same(model, library, texts):
    ids = [np.frombuffer(i, "<u4") for i in model.encode(texts)]
    assert [i.tolist() for i in ids] == [library.encode_ordinary(t) for t in texts]
    assert model.decode(ids) == [t.encode() for t in texts]


def test_odd_texts(model, library):
    same(model, library, [
        "", " ", "  ", "   a", " a  b ", "a\n b\t c \n  d", "\x1c \x1d x", "it's We'LL 12 345", "\n",
        "naïve über 你好世界 \U0001f600\U0001f680 ́", "  　x", "\x00\x01", "a   b",
        " \n", "x \n", "<|endoftext|>", "a" * 31 + " " + "b" * 32 + " " + "c" * 33,
    ])


def test_characters_that_unicode_versions_class_differently(model, library):
    rng = random.Random(3)
    odd = [chr(c) for c in (0x558, 0x88F, 0x1C89, 0xA7CB, 0x105C0, 0x1E5F6, 0x378, 0x10FFFF)]
    same(model, library, ["".join(rng.choices(odd + list("a1! é"), k=12)) for _ in range(300)])


def test_random_texts(model, library):
    rng = random.Random(1)
    letters = "aabcdeé你 \n\t.,'s12-_\U0001f600"
    same(model, library, ["".join(rng.choices(letters, k=rng.randrange(120))) for _ in range(400)])


def test_the_collector_rests_while_texts_are_encoded(model, library):
    started = []
    watch = lambda phase, info: started.append(phase)
    gc.callbacks.append(watch)
    try:
        ids = model.encode([" ".join(f"w{k}x{k * k}" for k in range(20_000))])
    finally:
        gc.callbacks.remove(watch)
    assert not started and gc.isenabled()
    text = " ".join(f"w{k}x{k * k}" for k in range(20_000))
    assert np.frombuffer(ids[0], "<u4").tolist() == library.encode_ordinary(text)


def test_long_pieces(model, library):
    rng = random.Random(2)
    same(model, library, [
        "a" * 5000, "ab" * 999, " " * 777, "-" * 1001, "aab" * 100 + "a" * 50, "9" * 400,
        "".join(rng.choices("acgt", k=4000)), "".join(rng.choices("etaoinshr", k=3000)),
        "".join(rng.choices("你好世界中国人", k=500)),
    ])


def plain_merge(ranks, piece):
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        found = [
            (ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks
        ]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_ranks_that_no_training_would_give():
    """A new token may merge on at a smaller rank than its own: leftmost first, one at a time."""
    rng = random.Random(5)
    for _ in range(15):
        words = {bytes(rng.choices(b"abc", k=rng.randrange(2, 5))) for _ in range(14)}
        order = list(words)
        rng.shuffle(order)
        ranks = {bytes([b]): b for b in range(256)} | {w: 256 + k for k, w in enumerate(order)}
        model = bp.BytePairs(ranks, PATTERN)
        pieces = [bytes(rng.choices(b"abc", k=k)) for k in (3, 8, 20, 32, 33, 60, 90) for _ in "12"]
        found = [np.frombuffer(i, "<u4").tolist() for i in model.merge(pieces)]
        assert found == [plain_merge(ranks, p) for p in pieces]


def test_small_bounds_change_nothing(library, monkeypatch):
    for name in ("QUERY_ROWS", "DECODE_IDS", "SEGMENT", "CACHE_STRETCHES", "ROUNDS"):
        monkeypatch.setattr(bp, name, 3)
    model = bp.BytePairs(bp.read_ranks(RANKS), PATTERN)
    text = "one two  three\n four fivesixseveneightnineteneleventwelvethirteen"
    parts = list(bp._segments(text))
    assert "".join(parts) == text and len(parts) > 2
    assert b"".join(model.encode(parts)) == np.array(
        library.encode_ordinary(text), "<u4").tobytes()
    same(model, library, [text, "x" * 40, text + text, "", "y"])


def test_unknown_ids_are_refused(model):
    with pytest.raises(ValueError):
        model.decode([np.array([1, 60_000], "<u4")])


def test_cases(spark, written, library):
    text = "Alle Menschen  sind\n\n frei, it's 1999!"
    rows = [(1, text, 5, b"x"), (2, None, 6, b"x"), (3, "", 7, b"x"), (None, "a", 8, b"x"),
            (1, text, 5, b"x"), (4, "wort " * 5000 + "z" * 3000, None, None)]
    path = written(documents=(rows, "doc_id long, text string, ids int, bytes binary"))
    found = sorted(map(tuple, bp.op13(spark, path).collect()), key=str)

    def row(doc_id, text):
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        digest = hashlib.sha256(ids.tobytes()).hexdigest()
        return doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()

    assert found == sorted((row(r[0], r[1]) for r in rows), key=str)


def test_empty_table(spark, written):
    path = written(documents=([], "doc_id long, text string"))
    assert bp.op13(spark, path).collect() == []


def test_given_documents_equal_the_library(spark, library):
    path = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in bp.op13(spark, path).collect()}
    for doc in spark.read.parquet(f"{path}/documents.parquet").collect():
        ids = np.array(library.encode_ordinary(doc.text or ""), "<u4")
        row = found[doc.doc_id]
        assert (row.n_tokens, row.ids_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()
