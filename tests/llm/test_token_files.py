import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cadenza.llm import token_files as tf
from cadenza.llm.common import shared_path

TEXTS = [
    (5, "Hello, World!  it's  fine\n\nyes"), (3, None), (1, ""), (None, "no key"),
    (7, "na\u00efve caf\u00e9 \u0130stanbul \u00a0 wide\u2003space \x1c\x85 sep"),
    (5, "Hello again"), (8, "A1b22.,;x!! (407)555-77 THE.ß schßung. ÀÉ÷× it's don't**"), (9, "<|endoftext|> x<|startoftext|>y"), (2, "word " * 30_000),
    (11, "\u4f60\u597d \U0001f600 e\u0301 \u0301lone \ud55c\uae00 123abc"), (None, None),
]


def expected(path):
    tokenizer = Tokenizer.from_file(path)
    ordered = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, out = 0, []
    for key, text in ordered:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_back_what_the_tokenizer_makes(spark, documents):
    path, tokenizer = shared_path(spark, "files"), tf.default_tokenizer()
    docs = documents(*TEXTS)
    tf.write_files(docs, path, tokenizer)
    got = [tuple(r)[:4] for r in tf.read_files(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(tokenizer)
    found = tf.lookup(spark, path, [5, 11, 4]).collect()
    assert sorted(r.doc_id for r in found) == [5, 5, 11]
    assert all(bytes(r.ids)[-2:] == b"\x02\x00" for r in found)


def test_no_documents_no_rows(spark, documents):
    path = shared_path(spark, "files")
    tf.write_files(documents((1, "x")).where("false"), path, tf.default_tokenizer())
    assert tf.read_files(spark, path).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 100, 20_000])
def test_index_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False)
    seeds, slot = tf.build_index(keys)
    assert sorted(slot.tolist()) == list(range(n))
    slots = np.zeros(n, tf._SLOT)
    slots["record"][slot], slots["copies"] = np.arange(n), 1
    slots["print"][slot] = (tf._hashes(keys)[0] >> np.uint64(32)).astype(np.uint32)
    there, record, _ = tf.find(keys, seeds.astype("<i4").tobytes(), slots.tobytes())
    assert there.all() and (record == np.arange(n)).all()
    there, *_ = tf.find(keys + (1 << 41), seeds.astype("<i4").tobytes(), slots.tobytes())
    assert there.sum() <= 1


def test_one_key_fills_many_shards_of_many_tasks(spark, documents, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_BYTES", 1000)
    path, tokenizer = shared_path(spark, "files"), tf.default_tokenizer()
    rows = [(key, f"{k} " + "word " * 100) for key in (None, 7) for k in range(60)]
    rows += [(7, "same " * 100)] * 60
    tf.write_files(documents(*rows), path, tokenizer)
    files = spark.read.schema(tf.FILES).parquet(path)
    shards = files.select("part", "shard", "n_docs", "n_null", "payload").collect()
    assert max(len(r.payload) for r in shards) <= 1000
    # Repeated keys and repeated rows of one key go to both tasks.
    assert {r.part for r in shards if r.n_docs > r.n_null} == {0, 1}
    got = tf.read_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 60 + [7] * 120
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    encoder = tf.WordEncoder(tokenizer)
    want = sorted(encoder.encode(text.encode()) + b"\x02\x00" for key, text in rows if key == 7)
    assert sorted(bytes(r.ids) for r in tf.lookup(spark, path, [7]).collect()) == want


def test_new_words_of_many_texts_are_learnt_at_once(monkeypatch):
    texts = [f"Word{k} other{k}'s, b{k % 7} été <|x|> {k}" if k % 9 == 0 else f"Plain{k} words {k} b!" for k in range(500)]
    plain = tf.WordEncoder(tf.default_tokenizer())
    want = [plain.encode(t.encode()) for t in texts]
    for most in (tf.CACHE_WORDS, 300):
        monkeypatch.setattr(tf, "CACHE_WORDS", most)
        encoder, calls = tf.WordEncoder(tf.default_tokenizer()), []
        one = encoder.learn
        monkeypatch.setattr(encoder, "learn", lambda words, one=one: (calls.append(1), one(words)))
        assert list(encoder.encode_all(pa.array(texts))) == want
        assert most == 300 or len(calls) == 1


def test_parts_are_looked_up_once_and_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(tf, "LEARN_BYTES", 200)
    marks = [",", ".", "!?", ";)", "--x", "7", "É", "'s", "×2", "<|", "İ", "\x1c"]
    texts = ["", " ", "".join(f"Über{a}{m} ÀLPHA{a}{b}\t" for a, m in enumerate(marks) for b in marks)]
    texts += [f"<|ENDOFTEXT|> <|endoftext|>a{m} Don{m}t{m}́" for m in marks] + ["été" * 900, ""]
    tokenizer, encoder = Tokenizer.from_file(tf.default_tokenizer()), tf.WordEncoder(tf.default_tokenizer())
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert list(encoder.encode_all(pa.array(texts))) == want
    # A plain word with another mark behind it is no new word.
    encoder = tf.WordEncoder(tf.default_tokenizer())
    list(encoder.encode_all(pa.array([f"Word{m} other{m}" for m in ",.;:!?"])))
    assert set(encoder.known) == {b"word", b"other", *(m.encode() for m in ",.;:!?")}
