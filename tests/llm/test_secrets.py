import hashlib
import random
import re
import string

from cadenza.llm import secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
RANDOM = "Zx8Qp2Lk9Vb4Nm7Wc3Rt6Yh1Jd5"
TEXTS = [
    (1, 'é😀 token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and AKIA0123456789ABCD'),
    (2, "token=pass secret:longvalue123 API_KEY: 'abcdefgh' Apikey=1234567"),
    (3, None), (4, ""), (5, "deadbeef" * 4 + " deadbeef AKIAAKIA AKIAAKIAAKIAAKIA"),
    (6, f"see {RANDOM} here and internationalizations thinkingandthinkingagain"),
    (7, "password=password=password=x"), (8, "token=secret=abcdefgh1 x" * 300),
    (None, "passwd : abcdefghij"), (1, "plain"), (9, "ſecret=abcdefghijk Key=1"),
]


def base(text):
    text, out = text or "", []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    names = ("assign", "access", "hex")
    return out, ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(out))


def fuzz():
    rng = random.Random(4)
    bits = ["token", "API_key", "secret", "=", ": ", '"', "'", " ", "abcdefgh", "AKIA", "A1B2C3D4E5F6", "0af9" * 9, "é"]
    return [(100 + k, "".join(rng.choices(bits, k=rng.randrange(25)))) for k in range(200)]


def test_base_equals_plain_scan(spark, documents, tmp_path):
    rows = TEXTS + fuzz()
    documents(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = secrets.op8(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)

    def want(text):
        found, joined = base(text)
        kinds = [k for _, k, _ in found]
        return (*(kinds.count(k) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest())

    key = lambda r: tuple((v is None, v) for v in r)
    found = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got]
    assert sorted(found, key=key) == sorted(((i, *want(t)) for i, t in rows), key=key)
    for r in got:
        starts = [int(s.split(":")[1]) for s in r.spans.split(",") if s]
        assert starts == sorted(starts)


def test_model_adds_spans_and_keeps_base_ones(spark, documents, tmp_path):
    documents(*TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    spans = {r.doc_id: r.spans for r in secrets.op8(spark, str(tmp_path)).collect() if r.doc_id}
    assert spans[6] == f"model:4:{4 + len(RANDOM)}"
    assert spans[5] == base(TEXTS[4][1])[1]


def test_models_tell_random_from_words(spark, documents):
    rng = random.Random(1)
    words = ["".join(rng.choices("etaoinshrdlu", k=9)) for _ in range(400)]
    docs = documents(*((k, " ".join(rng.choices(words, k=60))) for k in range(30)))
    table = secrets.ratios(secrets.labelled_strings(docs))

    def score(s):
        return sum(table[128 * ord(a) + ord(b)] for a, b in zip(s, s[1:]))

    random_ones = ["".join(rng.choices(string.ascii_letters + string.digits, k=24)) for _ in range(50)]
    assert sum(score(s) > secrets.MARGIN for s in random_ones) >= 45
    assert all(score(a + b + c) < secrets.MARGIN for a, b, c in zip(words, words[1:], words[2:]))


def test_stage_redacts(spark, documents):
    docs = documents(*TEXTS)
    out = secrets.stage(spark, docs, "")
    assert out.columns == docs.columns
    rows = {(r.doc_id, r.text): r for r in out.collect()}
    assert (1, "é😀 [assign]\" and [access]") in rows and (1, "plain") in rows
    assert (3, None) in rows and (4, "") in rows
    assert (6, "see [model] here and internationalizations thinkingandthinkingagain") in rows
    assert all(t is None or r.n_chars == len(t) for (_, t), r in rows.items())
    assert secrets.stage(spark, docs.where("false"), "").count() == 0
