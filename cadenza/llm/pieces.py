"""SentencePiece encoding and decoding by batched Viterbi (operator 9).

The pieces and their stored scores come from a model file; nothing is trained. The encoding of a
text is the segmentation of ``' ' + text`` (spaces written as the piece mark) with the greatest sum
of scores. A character that no piece covers costs 10 less than the lowest score and is written as
the pieces of its UTF-8 bytes. Among equal sums the one with the longest last piece wins, then the
same for the rest. Decoding joins the pieces, turns marks into spaces and takes off the first.

No piece holds a mark behind another character, so the best segmentation of a text is that of its
words one after another (also cut at line feeds if no piece holds one); each distinct word is
solved once. Words of one length form a matrix of characters and advance together: a step hashes
the substrings that end at one position, probes the sorted keys of the pieces, and takes the row
maxima, which are the back pointers.

Cases: missing and empty texts have no pieces and decode to the empty text; a text that holds the
mark itself decodes to a space there; repeated rows and ids are kept; other columns are ignored. A
word of any length is solved exactly (work in proportion to its length times the longest piece).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import Sums, mix, table, whole_texts

MARK = "▁"
#: Encoded words a worker remembers before it starts over.
CACHE_WORDS = 200_000
#: Characters of the words that advance together.
MATRIX = 1 << 20
_FILTER_BITS = 20
#: Texts whose new words are solved together.
BLOCK_BYTES = 2 << 20


class Pieces:
    def __init__(self, pieces: list[tuple[str, float, str]]):
        """pieces: (text, score, kind) by id; kind is normal, byte or another that is never used."""
        normal = [(t, s, i) for i, (t, s, kind) in enumerate(pieces) if kind == "normal" and t]
        if any(re.search(f"[^{MARK}]{MARK}", t) for t, _, _ in normal):
            raise ValueError("a piece spans two words")
        feeds = any("\n" in t for t, _, _ in normal)
        self.cut = re.compile(rb" *[^ ]+| +" if feeds else rb" *[^ \n]+| +|\n")
        self.longest = max(len(t) for t, _, _ in normal)
        self.unknown = min(s for _, s, _ in normal) - 10.0
        codes = np.concatenate([self._codes(t) for t, _, _ in normal])
        end = np.cumsum([len(t) for t, _, _ in normal])
        start = end - [len(t) for t, _, _ in normal]
        keys = Sums(codes).span(start, end)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a key")
        self.scores = np.array([s for _, s, _ in normal], float)[order]
        self.ids = np.array([i for _, _, i in normal], np.int32)[order]
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        self.bytes = np.full(256, -1, np.int32)
        self.text: list[bytes] = []
        for i, (t, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.bytes[int(t[3:5], 16)] = i
                self.text.append(bytes([int(t[3:5], 16)]))
            else:
                self.text.append(t.replace(MARK, " ").encode() if kind == "normal" else b"")
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte pieces")
        if len(pieces) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)

    def _solve(self, words: list[str], width: int) -> Iterator[bytes]:
        """Ids of words of at most ``width`` characters, which advance together."""
        n = len(words)
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(w.ljust(width) for w in words).encode("utf-32-le"), "<u4")
        codes = flat.reshape(n, width).astype(np.uint64) + np.uint64(1)
        power = Sums(np.zeros(width, np.uint64))  # for its inverse powers
        weights = np.ones(width, np.uint64)
        weights[1:] = 0x9E3779B97F4A7C15
        weights = np.multiply.accumulate(weights)
        sums = np.zeros((n, width + 1), np.uint64)
        np.cumsum(codes * weights, axis=1, out=sums[:, 1:])
        best = np.zeros((n, width + 1))
        came = np.zeros((n, width + 1), np.int32)
        piece = np.full((n, width + 1), -1, np.int32)
        rows = np.arange(n)
        for end in range(1, width + 1):
            low = max(0, end - self.longest)
            key = mix((sums[:, end : end + 1] - sums[:, low:end]) * power.inverse[low:end])
            row, col = np.nonzero(self.maybe[key >> np.uint64(64 - _FILTER_BITS)])
            probe = key[row, col]
            at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            hit = self.keys[at] == probe
            row, col, at = row[hit], col[hit], at[hit]
            score = np.full(key.shape, -np.inf)
            found = np.full(key.shape, -1, np.int32)
            score[:, -1] = self.unknown
            score[row, col], found[row, col] = self.scores[at], self.ids[at]
            score += best[:, low:end]
            take = score.argmax(1)  # the first maximum: the longest last piece
            best[:, end] = score[rows, take]
            came[:, end], piece[:, end] = low + take, found[rows, take]
        # Walk back, all words at once.
        at, live = lengths.copy(), rows
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(live):
            here = at[live]
            steps.append((live, here, piece[live, here]))
            at[live] = came[live, here]
            live = live[at[live] > 0]
        word, place, ids = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((place, word))
        word, place, ids = word[order], place[order], ids[order]
        cuts = np.searchsorted(word, np.arange(n + 1))
        strange = set(word[ids < 0].tolist())
        raw = ids.astype("<u2").tobytes()
        for k, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if k not in strange:
                yield raw[2 * low : 2 * high]
                continue
            parts = []
            for p, i in zip(place[low:high].tolist(), ids[low:high].tolist()):
                spelled = words[k][p - 1].encode() if i < 0 else b""
                parts.append(self.bytes[list(spelled)] if i < 0 else [i])
            yield np.concatenate(parts).astype("<u2").tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Solve new words: one matrix for each length (long ones in classes of nearly equal
        length: what stands behind a word's end never reaches its own back pointers)."""
        groups: dict[int, list[bytes]] = {}
        texts = {}
        for word in words:
            texts[word] = text = word.decode().replace(" ", MARK)
            n = len(text)
            width = n if n <= 24 else 1 << n.bit_length() if n > 256 else -(-n // 16) * 16
            groups.setdefault(width, []).append(word)
        for width, members in groups.items():
            step = max(1, MATRIX // width)
            for low in range(0, len(members), step):
                some = members[low : low + step]
                for word, ids in zip(some, self._solve([texts[w] for w in some], width)):
                    self.known[word] = ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 16-bit integers."""
        cut = [self.cut.findall(b" " + t) if t else [] for t in texts]
        new: set[bytes] = set()
        for words in cut:
            new.update(words)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
        self.learn(list(new.difference(self.known)))
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes) -> bytes:
        if not ids:
            return b""
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u2").tolist()))[1:]


def read_pieces(path: str) -> list[tuple[str, float, str]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        if model.is_byte(i):
            return "byte"
        return "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"

    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(len(model))]


@lru_cache(1)
def _pieces(path: str) -> Pieces:
    return Pieces(read_pieces(path))


def _blocks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of pieces of a batch, closed at BLOCK_BYTES."""
    low, some, size = 0, [], 0
    for text in texts:
        some.append(text.as_buffer().to_pybytes())
        size += len(some[-1])
        if size > BLOCK_BYTES:
            yield low, some
            low, some, size = low + len(some), [], 0
    if some:
        yield low, some


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            keys = batch.column("doc_id")
            for low, texts in _blocks(batch.column("text")):
                ids = pieces.encode(texts)
                ends = np.cumsum([0, *(len(i) // 2 for i in ids)]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), "<u2").astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(low, len(texts)), lists], ["doc_id", "ids"]
                )

    return whole_texts(docs).mapInArrow(work, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, text: what the ids spell (bytes that form no character become U+FFFD)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            texts = [
                pieces.decode(np.asarray(ids.values).astype("<u2").tobytes()).decode(errors="replace")
                for ids in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"],
            )

    return encoded.mapInArrow(work, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian unsigned 32-bit integers),
    decoded_sha256 and ``exact`` (the decoded text is the given one)."""
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, exact boolean"
    names = ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "exact"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            keys = batch.column("doc_id")
            for low, texts in _blocks(batch.column("text")):
                ids = pieces.encode(texts)
                back = [pieces.decode(i) for i in ids]
                wide = [np.frombuffer(i, "<u2").astype("<u4").tobytes() for i in ids]
                columns = [
                    keys.slice(low, len(texts)),
                    pa.array([len(i) // 2 for i in ids], pa.int64()),
                    pa.array([zlib.crc32(w) for w in wide], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in back]),
                    pa.array([a == b for a, b in zip(texts, back)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return whole_texts(docs).mapInArrow(work, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded again and compared; see ``round_trip``."""
    return round_trip(table(spark, sf_dir, "documents"), default_model())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: doc_id, ids and the text that the ids decode to."""
    return decode_ids(encode_texts(docs, default_model()), default_model())
