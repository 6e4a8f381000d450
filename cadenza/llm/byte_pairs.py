"""Byte-level BPE encoding and decoding by DuckDB queries inside each task (operator 13).

**Encoding.** A text is cut by the given pattern; a piece that is a token is that id, all others are
merged. A worker sends the pieces it has not met before to DuckDB as token-position rows (piece,
position, token, next token). A recursive query joins them with the merge table (a row for each pair
of tokens whose bytes together are a token; its id is its rank), takes each piece's leftmost pair of
minimum rank, contracts it and goes on until no pair merges. Pieces of more than ``LONG`` bytes take
a second recursive query that contracts all repetitions of that pair in one round, unless the new
token could lead to a smaller rank with a neighbour (then the leftmost alone), so its rounds count
the different ranks of a piece rather than its length; it hands its rows back every ``ROUNDS``
rounds, so what the recursion has gathered stays bounded.

**Decoding.** Ids of many documents, with their positions, join the table of tokens; an ordered
aggregation puts each document's bytes together.

Texts are looked up by stretches between single spaces: the pattern always cuts before a space that
follows a visible character, so equal stretches have equal ids. A worker remembers up to
``CACHE_STRETCHES`` of them, then starts over. Each DuckDB instance lives in its worker's memory
with one thread and never writes a file.

Nothing is shuffled: a document is encoded and decoded where it was read; a long text passes in
segments of about ``SEGMENT`` characters.

Characters that Unicode versions class differently (only those unknown to Python's own table can be)
are asked from the tokenizer library one by one, so that the cuts are the library's.

Cases: missing and empty texts have no ids and decode to no bytes; repeated rows and missing or
repeated doc_ids each give a row; an empty table gives no row; other columns are ignored; ids that
the vocabulary does not hold are an error.
"""

from __future__ import annotations

import base64
import gc
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import for_workers, table, whole_texts

#: Pieces of more bytes take the query for long pieces; it hands back after so many rounds.
LONG, ROUNDS = 32, 16
#: Token rows that one recursive query starts from, unless a single piece has more.
QUERY_ROWS = 1 << 20
#: Ids that one decoding query takes.
DECODE_IDS = 1 << 20
SEGMENT = 1 << 20
CACHE_STRETCHES = 300_000

_CUT = re.compile(r"(?<=\S) ")
_UNEVEN = re.compile(r"\s ")

# place is piece << 32 | position, pair is token << 32 | next token (all ones at the end of a piece).
# Each piece's pair of least rank, then position, is contracted: its first row goes, its second
# becomes the new token, and rows behind move up by one.
_SHORT = """
with recursive state(place, pair, live) as (
    select piece::bigint << 32 | pos, tok::bigint << 32 | (nxt::bigint & 4294967295), true from fresh
    union all (
    with least as (
        select s.place >> 32 as piece, min(m.id::bigint << 32 | (s.place & 4294967295)) as best
        from state s join merges m on m.pair = s.pair
        where s.live group by 1
    ),
    chosen as (
        select piece, piece << 32 | (best & 4294967295) as at, best >> 32 as id from least
    )
    select case when s.place > c.at then s.place - 1 else s.place end,
           case when s.place = c.at + 1 then c.id << 32 | (s.pair & 4294967295)
                when s.place = c.at - 1 then (s.pair >> 32) << 32 | c.id
                else s.pair end,
           c.at is not null
    from state s left join chosen c on c.piece = s.place >> 32
    where s.live and (c.at is null or s.place <> c.at))
)
select (place >> 32)::int as piece, (pair >> 32)::int as tok from state where not live order by place
"""

# Pairs of equal tokens overlap in a run: from its start, every other one is contracted.
_LONG = """
with recursive state(piece, pos, tok, live, round) as (
    select piece, pos, tok, true, 0 from fresh
    union all (
    with pairs as (
        select piece, pos, tok, round, lead(tok) over (partition by piece order by pos) as nxt
        from state where live and round < $rounds
    ),
    ranked as (
        select p.*, m.id, m.alone, min(m.id) over (partition by p.piece) as best
        from pairs p left join merges m on m.pair = (p.tok::bigint << 32 | p.nxt::bigint)
    ),
    hits as (select *, coalesce(id = best, false) as hit from ranked),
    runs as (
        select *, count(*) filter (not hit) over w as run, count(*) filter (hit) over w as nth
        from hits window w as (partition by piece order by pos)
    ),
    taken as (
        select *, hit and case when alone then nth = 1
            else row_number() over (partition by piece, run, hit order by pos) % 2 = 1 end as take
        from runs
    ),
    kept as (
        select *, coalesce(lag(take) over (partition by piece order by pos), false) as gone
        from taken
    )
    select piece, pos, case when take then best else tok end, best is not null, round + 1
    from kept where not gone)
)
select piece, pos, tok, live from state
where not live or round = $rounds
order by piece, pos
"""

_DECODE = """
select doc, array_to_string(list(bytes order by pos), '') as text
from given join tokens on tokens.id = given.id group by doc
"""


class BytePairs:
    """The merge table and the vocabulary in a DuckDB of this process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(
            ":memory:",
            config={"threads": 1, "memory_limit": "700MB", "temp_directory": ""},
        )
        pairs, ids = [], []
        least: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    ids.append(rank)
                    for part in (left, right):
                        least[part] = min(rank, least.get(part, rank))
        # A token that some neighbour merges with at a smaller rank than its own.
        alone = [least.get(i, i) < i for i in ids]
        self._make("merges", pair=pa.array(pairs, pa.int64()), id=pa.array(ids, pa.int32()),
                   alone=pa.array(alone, pa.bool_()))
        # Bytes as the characters of the same numbers: any byte string is then a text.
        self._make("tokens", id=pa.array(list(ranks.values()), pa.int32()),
                   bytes=pa.array([t.decode("latin-1") for t in ranks]))
        self.known: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}

    def _make(self, name: str, **columns: pa.Array) -> None:
        self.con.register("given_table", pa.table(columns))
        self.con.execute(f"create table {name} as select * from given_table")
        self.con.unregister("given_table")

    def _query(self, sql: str, rows: pa.Table, name: str) -> pa.Table:
        self.con.register(name, rows)
        found = self.con.sql(sql).to_arrow_table()
        self.con.unregister(name)
        return found

    def _rows(self, pieces: list[bytes]) -> pa.Table:
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        tok = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        nxt = np.append(tok[1:], -1).astype(np.int32)
        nxt[ends - 1] = -1
        return pa.table(
            {
                "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
                "pos": (np.arange(len(tok)) - np.repeat(ends - lengths, lengths)).astype(np.int32),
                "tok": tok,
                "nxt": nxt,
            }
        )

    def _contract(self, rows: pa.Table) -> pa.Table:
        """Long pieces, ``ROUNDS`` rounds at a time."""
        done, sql = [], _LONG.replace("$rounds", str(ROUNDS))
        while len(rows):
            found = self._query(sql, rows, "fresh")
            live = found["live"].to_numpy()
            done.append(found.filter(pa.array(~live)).select(["piece", "pos", "tok"]))
            rows = found.filter(pa.array(live)).select(["piece", "pos", "tok"])
        return pa.concat_tables(done).sort_by([("piece", "ascending"), ("pos", "ascending")])

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers."""
        result: list[bytes] = [b""] * len(pieces)
        groups: dict[bool, list[int]] = {False: [], True: []}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                result[k] = whole.to_bytes(4, "little")
            elif piece:
                groups[len(piece) > LONG].append(k)
        for long, members in groups.items():
            low = 0
            while low < len(members):
                high, size = low, 0
                while high < len(members) and (high == low or size + len(pieces[members[high]]) <= QUERY_ROWS):
                    size += len(pieces[members[high]])
                    high += 1
                some = members[low:high]
                rows = self._rows([pieces[k] for k in some])
                found = self._contract(rows) if long else self._query(_SHORT, rows, "fresh")
                raw = found["tok"].to_numpy().astype("<u4").tobytes()
                cuts = 4 * np.searchsorted(found["piece"].to_numpy(), np.arange(len(some) + 1))
                for k, begin, end in zip(some, cuts[:-1].tolist(), cuts[1:].tolist()):
                    result[k] = raw[begin:end]
                low = high
        return result

    def pieces(self, text: str) -> list[str]:
        """The pattern's matches in a text."""
        if not text.isascii():
            odd = {c for c in set(text) if unicodedata.category(c) == "Cn"}
            if odd:
                plain = text.translate({ord(c): _stand_in(c, self.pattern.pattern) for c in odd})
                return [text[slice(*m.span())] for m in self.pattern.finditer(plain)]
        return self.pattern.findall(text)

    def _learn(self, texts: list[str]) -> list[bytes]:
        """Ids of stretches: those without line ends are cut in one go, a line for each."""
        lines = [
            k for k, t in enumerate(texts)
            if "\n" not in t and not t[1:2].isspace() and not t[-1:].isspace()
        ]
        cut = self.pieces("\n".join([texts[k] for k in lines]))
        ends = [k for k, p in enumerate(cut) if p == "\n"]
        ends.append(len(cut))
        if len(ends) != len(lines):
            lines, cut, ends = [], [], []
        rest = set(range(len(texts))).difference(lines)
        others = {k: self.pieces(texts[k]) for k in rest}
        # Flat lists only: a list for each stretch would keep the garbage collector busy.
        used = set(cut).union(*others.values())
        new = used.difference(self.merged)
        if len(self.merged) + len(new) > CACHE_STRETCHES:
            self.merged.clear()
            new = used
        fresh = list(new)
        self.merged.update(zip(fresh, self.merge([p.encode() for p in fresh])))
        ids = self.merged.__getitem__
        result, low = [b""] * len(texts), 0
        for k, high in zip(lines, ends):
            one = high - low == 1
            result[k] = ids(cut[low]) if one else b"".join(map(ids, cut[low:high]))
            low = high + 1
        for k, pieces in others.items():
            result[k] = b"".join(map(ids, pieces))
        return result

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers. Nothing here is cyclic, so the
        garbage collector would only walk the libraries again and again; it rests meanwhile."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collects:
                gc.enable()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        cut = [(_CUT.split(t) if _UNEVEN.search(t) else t.split(" ")) if t else [] for t in texts]
        for cuts in cut:
            if len(cuts) > 1 and not cuts[0]:  # the space that opens a text follows nothing
                cuts[:2] = [" " + cuts[1]]
        new = {w for words in cut for w in words[1:]}.difference(self.known)
        if len(self.known) + len(new) > CACHE_STRETCHES:
            self.known.clear()
            new = {w for words in cut for w in words[1:]}
        begin = list({words[0] for words in cut if words}.difference(self.starts))
        if len(self.starts) + len(begin) > CACHE_STRETCHES:
            self.starts.clear()
            begin = list({words[0] for words in cut if words})
        rest = list(new)
        found = self._learn(begin + [" " + w for w in rest])
        self.starts.update(zip(begin, found))
        self.known.update(zip(rest, found[len(begin) :]))
        known = self.known.__getitem__
        return [
            self.starts[words[0]] + b"".join(map(known, words[1:])) if words else b""
            for words in cut
        ]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        lengths = np.array([len(i) for i in ids], np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        rows = pa.table(
            {
                "doc": np.repeat(np.arange(len(ids), dtype=np.int32), lengths),
                "pos": (np.arange(len(flat)) - np.repeat(first, lengths)).astype(np.int32),
                "id": flat,
            }
        )
        if len(flat) and not np.isin(flat, np.fromiter(self.ranks.values(), np.int64)).all():
            raise ValueError("an id that the vocabulary does not hold")
        found = self._query(_DECODE, rows, "given")
        result = [b""] * len(ids)
        for doc, text in zip(found["doc"].to_pylist(), found["text"].to_pylist()):
            result[doc] = text.encode("latin-1")
        return result


@lru_cache(None)
def _stand_in(char: str, pattern: str) -> str:
    """A well-known character that the library's pattern treats as it treats ``char``: the library
    merges it with a neighbour of the same class only."""
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {bytes([ord(n), b]): 256 * (k + 1) + b for k, n in enumerate("a1!") for b in range(256)}
    probe = tiktoken.Encoding(
        "probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    for near in "a1!":
        if probe.encode_ordinary(near + char)[0] >= 256:
            return near if near != "a" else "ä"
    return " "


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@lru_cache(1)
def _byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(read_ranks(path), pattern)


def _segments(text: str) -> Iterator[str]:
    """A text in parts of about SEGMENT characters, each but the first opening with a single space
    that follows a visible character: the pattern cuts there."""
    low = 0
    while len(text) - low > SEGMENT:
        cut = _CUT.search(text, low + SEGMENT)
        if not cut:
            break
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:]


def encode_texts(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _byte_pairs(ranks, pattern)
        for batch in batches:
            rows = []
            some, owner, size = [], [], 0

            def flush() -> None:
                for k, ids in zip(owner, model.encode(some)):
                    rows[k].append(ids)
                some.clear()
                owner.clear()

            for k, text in enumerate(batch.column("text")):
                rows.append([])
                for part in _segments(text.as_py()):
                    some.append(part)
                    owner.append(k)
                    size += len(part)
                    if size > SEGMENT:
                        flush()
                        size = 0
            flush()
            ids = pa.array([b"".join(r) for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return whole_texts(docs).mapInArrow(work, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids and bytes (binary): what the ids spell."""
    for_workers(encoded.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _byte_pairs(ranks, pattern)
        for batch in batches:
            spelled: list[list[bytes]] = []
            some, owner, size = [], [], 0

            def flush() -> None:
                for k, text in zip(owner, model.decode(some)):
                    spelled[k].append(text)
                some.clear()
                owner.clear()

            for k, ids in enumerate(batch.column("ids")):
                spelled.append([])
                raw = np.frombuffer(ids.as_buffer(), "<u4") if ids.is_valid else np.zeros(0, "<u4")
                for low in range(0, len(raw), DECODE_IDS):
                    some.append(raw[low : low + DECODE_IDS])
                    owner.append(k)
                    size += len(some[-1])
                    if size >= DECODE_IDS:
                        flush()
                        size = 0
            flush()
            texts = pa.array([b"".join(s) for s in spelled], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), texts], ["doc_id", "ids", "bytes"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        work, "doc_id long, ids binary, bytes binary"
    )


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    files = default_files()
    back = decode_ids(encode_texts(table(spark, sf_dir, "documents"), *files), *files)
    return back.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
