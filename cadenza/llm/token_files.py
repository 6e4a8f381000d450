"""Token ids in binary shard files with a minimal perfect hash index (operator 7).

File format, one record per shard (a Parquet row, committed by Spark, so any shared store holds it):

=========  ============================================================================
part       number of the key range the shard belongs to; shard: its number in there
n_docs     documents, in ascending key order (missing keys first, ``n_null`` of them)
n_ids      ids of all documents
payload    ids as little-endian unsigned 16-bit integers, document after document
ends       end of each document in the payload, in ids, little-endian unsigned 64 bit
seeds      index, first level: a displacement for each bucket of keys (int32, little endian)
slots      index, second level: for each slot the first document of the key (uint32), the number of
           documents that carry the key (uint32) and the key's fingerprint (uint32)
keys       the distinct keys, ascending (int64), for scans
=========  ============================================================================

A key hashes to a bucket; a bucket's displacement sends each of its keys to a slot of its own, and
there are as many slots as keys. A lookup reads one displacement and one slot, whatever the size.
A key that is not there finds another key's fingerprint (a false hit has a chance of 2^-32).

A key's documents may fill several shards, in a row; each indexes those it holds, and a lookup asks
every shard.

Cases: missing and empty texts have the end id alone; repeated keys are kept, next to each other,
ordered by the first ``PREFIX`` characters of the text, then by its hash; missing keys are kept and come first, and only scans return them; an empty table
gives no shard and no row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import (
    Sums, cut_slices, for_workers, lowered, mix, numbers, shared_path, table, whole_texts,
)

END_ID = 2
#: A shard closes at this many payload bytes or documents.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 16
PREFIX = 64
#: Encoded words a worker remembers before it starts over.
CACHE_WORDS = 600_000
#: Bytes of the texts whose new parts it learns at once.
LEARN_BYTES = 1 << 20

#: Words without apostrophes, of characters that normalisation leaves alone but for their case.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Kinds of bytes: white space, letters, digits, other plain ones, all else. 0xC3 begins À to ÿ.
_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F], _KIND[0x27] = _OTHER, _ODD
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT

FILES = (
    "part int, shard int, n_docs long, n_null long, n_ids long, payload binary, ends binary, "
    "seeds binary, slots binary, keys binary"
)
_SLOT = np.dtype([("record", "<u4"), ("copies", "<u4"), ("print", "<u4")])
_TRIES = 1 << 14


class WordEncoder:
    """Encodes word by word: the tokenizer's splits never cross ASCII white space, which it drops.

    Plain Latin words are split here as the tokenizer does (runs of letters, single digits, runs of
    other characters; it ignores case). Many new parts are spelled in its byte characters, given to
    its model as one text and cut where an id ends a part. All other words are encoded one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        plain = filter(_PLAIN.fullmatch, map(chr, range(256)))
        self.spelled = str.maketrans({c: spell(c)[0][0] for c in plain} | {" ": " "})
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        for name, i in names.items():
            self.ends[i] = name.endswith("</w>")
        if len(self.ends) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def _part_ids(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(parts), 1000):
            some = parts[k : k + 1000]
            text = " ".join(some).translate(self.spelled)
            found = self.model.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u2")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                out += [self._ids(part).tobytes() for part in some]
                continue
            raw, cuts = ids.tobytes(), [0, *(2 * cuts).tolist()]
            out += [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return out

    def learn(self, words: list[bytes]) -> None:
        plain: list[tuple[bytes, list[str]]] = []
        for word in words:
            text = word.decode()
            if _PLAIN.fullmatch(text) and "<|" not in text:
                plain.append((word, _PARTS.findall(text.lower())))
            else:
                self.known[word] = self._ids(text).tobytes()
        new = {part for _, parts in plain for part in parts}.difference(self.parts)
        if len(self.parts) + len(new) > CACHE_WORDS:
            self.parts.clear()
            new = {part for _, parts in plain for part in parts}
        some = list(new)
        self.parts.update(zip(some, self._part_ids(some)))
        ids = self.parts.__getitem__
        for word, parts in plain:
            self.known[word] = ids(parts[0]) if len(parts) == 1 else b"".join(map(ids, parts))

    def encode(self, text: bytes) -> bytes:
        if b"<|" not in text:  # a special token keeps its case, all else loses it
            text = text.lower()
        words = text.split()
        new = set(words).difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHE_WORDS:
                self.known.clear()
                new = set(words)
            self.learn(list(new))
        return b"".join(map(self.known.__getitem__, words))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Texts in order, about ``LEARN_BYTES`` at a time: each different part is looked up once in
        there, the new ones are learnt at once."""
        held: list[bytes] = []
        at = -1
        for row, data, offsets in cut_slices(texts, _KIND == _SPACE, LEARN_BYTES):
            first, *others = self._several(data, offsets)
            if row != at and held:
                yield b"".join(held)
                held = []
            held.append(first)  # a long text comes in several pieces
            for text in others:
                yield b"".join(held)
                held = [text]
            at = row
        if held:
            yield b"".join(held)

    def _several(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        data, start, end, odd = _cut(data, offsets)
        hashes = Sums(data.astype(np.uint64) + np.uint64(1)).span(start, end)
        _, some, place = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        parts = [raw[a:b] for a, b in zip(start[some].tolist(), end[some].tolist())]
        spelled = list(map(self.known.get, parts))
        new = [k for k, ids in enumerate(spelled) if ids is None]
        if new and len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(range(len(parts)))
        whole = odd[some[new]]
        if whole.any():
            self.learn([parts[k] for k, one in zip(new, whole.tolist()) if one])
        plain = [parts[k] for k, one in zip(new, whole.tolist()) if not one]
        self.known.update(zip(plain, self._part_ids([part.decode() for part in plain])))
        for k in new:
            spelled[k] = self.known[parts[k]]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 2
        begins, size = np.cumsum(sizes) - sizes, sizes[place]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = np.repeat(begins[place] - ends[:-1], size) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(spelled), "<u2")[flat].tobytes()
        cuts = (2 * ends[np.searchsorted(start, offsets)]).tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Texts with plain words in lower case, where their parts begin and end (those of plain words,
    and all other words whole), and whether a part is such a word."""
    n = len(data)
    kind, lower = _KIND[data], lowered(data)
    lead = np.flatnonzero(data == 0xC3)
    after = data[lead + 1]
    letter = (after != 0x97) & (after != 0xB7)  # neither × nor ÷
    kind[lead] = kind[lead + 1] = np.where(letter, _LETTER, _ODD)
    lower[lead + 1] += np.where(letter & (after < 0x9F), 0x20, 0).astype(np.uint8)
    kind[:-1][(data[:-1] == 0x3C) & (data[1:] == 0x7C)] = _ODD  # may begin a special token
    odd = np.flatnonzero(kind == _ODD)
    edge = offsets[:-1][offsets[:-1] < n]
    if len(odd):
        word = kind != _SPACE
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        begins[edge] = word[edge]
        # A word ends at the next white space or text.
        ends = ~word
        ends[edge] = True
        first, last = np.flatnonzero(begins), np.append(np.flatnonzero(ends), n)
        first = first[np.unique(np.searchsorted(first, odd, "right") - 1)]
        change = np.zeros(n + 1, np.int8)
        change[first] = 1
        change[last[np.searchsorted(last, first, "right")]] -= 1
        whole = np.cumsum(change[:-1], dtype=np.int8) > 0
        kind[whole], lower[whole] = _ODD, data[whole]
    begins = kind == _DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins[:1] = True
    begins[edge] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], n)[: len(start)]
    seen = kind[start] != _SPACE
    start, end = start[seen], end[seen]
    return lower, start, end, kind[start] == _ODD


@lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _hashes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h, mix(h ^ np.uint64(0xD6E8FEB86659FD93))


def _spot(h: np.ndarray, tries: np.ndarray, n: int) -> np.ndarray:
    return (mix(h + tries.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % n).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements, and the slot of each of the distinct keys. Large buckets choose first; a
    bucket of one key takes any free slot by name (a negative displacement)."""
    n = len(keys)
    h, other = _hashes(keys)
    n_buckets = n // 3 + 1
    bucket = (h % n_buckets).astype(np.int64)
    seeds = np.zeros(n_buckets, np.int32)
    slot = np.zeros(n, np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    starts = np.cumsum(sizes) - sizes
    free = np.ones(n, bool)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[: np.count_nonzero(sizes > 1)].tolist():
        members = order[starts[b] : starts[b] + sizes[b]]
        for low in range(1, _TRIES * 1024, 64):
            tries = np.arange(low, low + 64)
            spots = _spot(other[members][:, None], tries[None, :], n)
            good = free[spots].all(0)
            for k in np.flatnonzero(good).tolist():
                if len(np.unique(spots[:, k])) == len(members):
                    break
            else:
                continue
            seeds[b], slot[members] = tries[k], spots[:, k]
            free[spots[:, k]] = False
            break
        else:
            raise RuntimeError("no displacement found")
    single = order[starts[sizes == 1]]
    slot[single] = np.flatnonzero(free)
    seeds[bucket[single]] = -slot[single] - 1
    return seeds, slot


def find(keys: np.ndarray, seeds: bytes, slots: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: whether the shard holds it, its first document and how many carry it."""
    seed, slot = np.frombuffer(seeds, "<i4"), np.frombuffer(slots, _SLOT)
    if not len(slot):
        nothing = np.zeros(len(keys), np.int64)
        return nothing.astype(bool), nothing, nothing
    h, other = _hashes(keys)
    d = seed[(h % len(seed)).astype(np.int64)].astype(np.int64)
    at = np.where(d < 0, -d - 1, _spot(other, np.maximum(d, 0), len(slot)))
    hit = slot[at]
    there = hit["print"] == (h >> np.uint64(32)).astype(np.uint32)
    return there, hit["record"].astype(np.int64), hit["copies"].astype(np.int64)


class _Shard:
    def __init__(self, part: int, number: int):
        self.part, self.number = part, number
        self.keys: list[np.ndarray] = []
        self.nulls, self.payload, self.size, self.lengths = 0, [], 0, []

    def row(self) -> dict:
        keys = np.concatenate(self.keys)[self.nulls :]
        keys, first, copies = np.unique(keys, return_index=True, return_counts=True)
        seeds, slot = build_index(keys) if len(keys) else (np.zeros(0, np.int32), keys)
        slots = np.zeros(len(keys), _SLOT)
        slots["record"][slot], slots["copies"][slot] = first + self.nulls, copies
        slots["print"][slot] = (_hashes(keys)[0] >> np.uint64(32)).astype(np.uint32)
        ends = np.cumsum(np.array(self.lengths, "<u8"))
        return {
            "part": self.part, "shard": self.number, "n_docs": len(ends), "n_null": self.nulls,
            "n_ids": int(ends[-1]), "payload": b"".join(self.payload), "ends": ends.tobytes(),
            "seeds": seeds.astype("<i4").tobytes(), "slots": slots.tobytes(),
            "keys": keys.astype("<i8").tobytes(),
        }


def write_files(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every document and write the shard files, in ascending key order.

    Documents are dealt by ranges of the key, text and copy before they are encoded (one shuffle, of
    the texts), so a task meets its keys in order and holds one shard at a time, and the rows of one
    key, or without one, are spread over tasks and shards.
    """
    spark = documents.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["doc_id", "prefix", "hash", "copy"]
    dealt = (
        whole_texts(documents)
        .select(
            "doc_id",
            F.substring("text", 1, PREFIX).alias("prefix"),
            F.xxhash64("text").alias("hash"),
            F.monotonically_increasing_id().alias("copy"),
            "text",
        )
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = pa.schema(
        [(f, pa.int32()) for f in ("part", "shard")]
        + [(f, pa.int64()) for f in ("n_docs", "n_null", "n_ids")]
        + [(f, pa.binary()) for f in ("payload", "ends", "seeds", "slots", "keys")]
    )
    end = np.array([end_id], "<u2").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part = TaskContext.get().partitionId()
        shard = _Shard(part, 0)
        for batch in batches:
            ids, absent = numbers(batch.column("doc_id")), batch.column("doc_id").is_null()
            absent = absent.to_numpy(zero_copy_only=False)
            for k, payload in enumerate(encoder.encode_all(batch.column("text"))):
                payload += end
                full = shard.size + len(payload) > SHARD_BYTES or len(shard.lengths) >= SHARD_DOCS
                if full and shard.lengths:
                    yield pa.RecordBatch.from_pylist([shard.row()], schema)
                    shard = _Shard(part, shard.number + 1)
                shard.keys.append(ids[k : k + 1])
                shard.nulls += int(absent[k])
                shard.payload.append(payload)
                shard.size += len(payload)
                shard.lengths.append(len(payload) // 2)
        if shard.lengths:
            yield pa.RecordBatch.from_pylist([shard.row()], schema)

    dealt.mapInArrow(pack, FILES).write.option("compression", "zstd").parquet(path)


def starts(files: DataFrame) -> DataFrame:
    """part, shard and ``base``, the ids of all shards before it. Sums per part are few (one per
    task of the writer); within a part the shards are summed by a window."""
    sizes = files.select("part", "shard", "n_ids")
    totals = sorted(sizes.groupBy("part").agg(F.sum("n_ids")).collect())
    before, at = [], 0
    for part, total in totals:
        before.append((part, at))
        at += total
    spark = files.sparkSession
    parts = spark.createDataFrame(before, "part int, part_base long")
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return sizes.join(parts, "part").select(
        "part",
        "shard",
        (F.col("part_base") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).alias("base"),
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (int array as bytes of uint16) of every document, by the index."""
    return _scan(spark, path, keep_ids=True)


def _scan(spark: SparkSession, path: str, keep_ids: bool) -> DataFrame:
    for_workers(spark)
    files = spark.read.schema(FILES).parquet(path)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if keep_ids:
        schema, names = schema + ", ids binary", [*names, "ids"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {c: batch.column(c)[row] for c in batch.schema.names}
                ends = np.frombuffer(shard["ends"].as_py(), "<u8").astype(np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                keys = np.frombuffer(shard["keys"].as_py(), "<i8")
                there, record, copies = find(
                    keys, shard["seeds"].as_py(), shard["slots"].as_py()
                )
                if not there.all():
                    raise ValueError("the index misses a key of its shard")
                n_null, base = shard["n_null"].as_py(), shard["base"].as_py()
                owner = np.zeros(len(ends), np.int64)
                covered = np.zeros(len(ends), np.int64)
                covered[:n_null] = 1
                for c in range(int(copies.max(initial=0))):
                    with_c = copies > c
                    owner[record[with_c] + c] = keys[with_c]
                    covered[record[with_c] + c] += 1
                if not (covered == 1).all():
                    raise ValueError("the index does not cover the shard once")
                payload = np.frombuffer(shard["payload"].as_buffer(), "<u2")
                pieces = [payload[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
                out = [
                    pa.array(owner, mask=np.arange(len(ends)) < n_null),
                    pa.array(begins + base),
                    pa.array(ends - begins),
                    pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64()),
                ]
                if keep_ids:
                    out.append(pa.array([p.tobytes() for p in pieces], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names)

    return files.join(starts(files), ["part", "shard"]).mapInArrow(unpack, schema)


def lookup(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """doc_id and ids (uint16 bytes) of a stated list of keys: each shard is asked by its index, and
    only the found spans of its payload are copied out."""
    keys = np.array(wanted, np.int64)
    files = spark.read.schema(FILES).parquet(path)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in (row for batch in batches for row in batch.to_pylist()):
            there, record, copies = find(keys, shard["seeds"], shard["slots"])
            # A fingerprint may be another key's; the stored keys decide.
            there &= np.isin(keys, np.frombuffer(shard["keys"], "<i8"))
            ends = np.concatenate([[0], np.frombuffer(shard["ends"], "<u8").astype(np.int64)])
            hits = [
                (int(key), shard["payload"][2 * ends[r] : 2 * ends[r + 1]])
                for key, at, n in zip(keys[there], record[there], copies[there])
                for r in range(at, at + n)
            ]
            if hits:
                ids, payloads = zip(*hits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(payloads, pa.binary())], ["doc_id", "ids"]
                )

    columns = ["payload", "ends", "seeds", "slots", "keys"]
    return files.select(columns).mapInArrow(probe, "doc_id long, ids binary")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token files and read back; see ``queries``."""
    path = shared_path(spark, "token-files")
    write_files(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return _scan(spark, path, keep_ids=False)
