import random

import numpy as np
import pytest

from cadenza.llm import pieces as pc

SMALL = (
    [("<unk>", 0.0, "other")]
    + [(f"<0x{i:02X}>", 0.0, "byte") for i in range(256)]
    + [(t, s, "normal") for t, s in [
        ("▁", -6.0), ("a", -3.0), ("b", -3.0), ("ab", -5.0), ("▁a", -4.0), ("ba", -6.0),
        ("aba", -7.5), ("▁▁", -7.0), ("é", -4.0), ("bé", -5.0), ("▁ab", -6.0),
    ]]
)


def plain(pieces, text):
    """One text, character by character."""
    if not text:
        return []
    text = (" " + text).replace(" ", pc.MARK)
    score = {t: (s, i) for i, (t, s, k) in enumerate(pieces) if k == "normal"}
    unknown = min(s for s, _ in score.values()) - 10
    best, came = [0.0], [None]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - 16), end):
            found = score.get(text[start:end])
            if found:
                options.append((best[start] + found[0], -start, found[1]))
            elif end - start == 1:
                options.append((best[start] + unknown, -start, None))
        top = max(options, key=lambda o: (o[0], o[1]))
        best.append(top[0])
        came.append(top)
    ids, end = [], len(text)
    while end:
        _, start, i = came[end]
        bytes_of = {int(t[3:5], 16): k for k, (t, _, kind) in enumerate(pieces) if kind == "byte"}
        ids[:0] = [i] if i is not None else [bytes_of[b] for b in text[-start:end].encode()]
        end = -start
    return ids


def ids_of(model, texts):
    return [np.frombuffer(i, "<u2").tolist() for i in model.encode([t.encode() for t in texts])]


def test_small_model_equals_plain_viterbi():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab é\nx", k=rng.randrange(0, 40))) for _ in range(300)]
    texts += ["", " ", "  ", "a" * 700, "\U0001f600 b", "ab" * 150 + " a"]
    model = pc.Pieces(SMALL)
    assert ids_of(model, texts) == [plain(SMALL, t) for t in texts]
    back = [model.decode(i).decode() for i in model.encode([t.encode() for t in texts])]
    assert back == texts


def test_given_model_equals_plain_viterbi():
    pieces = pc.read_pieces(pc.default_model())
    model = pc.Pieces(pieces)
    texts = ["The quick  brown fox\njumps.", "naïve été 你好", "x" * 300, "\tIndent 123,456!"]
    assert ids_of(model, texts) == [plain(pieces, t) for t in texts]


def test_query_cases(spark, documents):
    texts = [(1, "one two"), (2, None), (3, ""), (1, "one two"), (None, "mark ▁ lost")]
    got = pc.round_trip(documents(*texts), pc.default_model()).collect()
    by = {(r.doc_id, r.exact) for r in got}
    assert len(got) == 5 and by == {(1, True), (2, True), (3, True), (None, False)}
    docs = documents(*texts)
    staged = pc.stage(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in staged)[0] == (0, "mark   lost")
    assert pc.round_trip(docs.where("false"), pc.default_model()).count() == 0


@pytest.mark.parametrize("size", [3, 1000])
def test_cache_starts_over(monkeypatch, size):
    monkeypatch.setattr(pc, "CACHE_WORDS", size)
    model = pc.Pieces(SMALL)
    for text in ["ab a b", "ba ab aba", "a b ab ba aba"]:
        assert ids_of(model, [text]) == [plain(SMALL, text)]
