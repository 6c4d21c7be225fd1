"""Byte-level BPE encoding and decoding.

Texts become arrays of codepoints, each codepoint a symbol: its class (letter,
number, white space, other) with what the next codepoints say. A small automaton
over these symbols knows where the splitting pattern starts a new piece. Each symbol
is a transition function on the automaton's states; the functions close into a
finite monoid, so a prefix scan with the monoid's multiplication table (an
associative operation) gives the state before every codepoint without a regex and
without a loop over codepoints. The slices between the boundaries go through a
cache of merged pieces; a miss is merged by ranks, which the library does for a
single piece. Offsets are kept for decoding.

Classes come from the tiktoken library itself (which codepoints its \\p{L}, \\p{N}
and \\s match), so both have the same Unicode version.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from reelspark.llm.common import once, shipped, slices, text_of

BATCH_BYTES = 1 << 20
#: Pieces that a worker keeps merged; beyond, it starts anew. Bounds its memory, not its results.
CACHE_PIECES = 250_000
#: Longer pieces are merged anew each time.
CACHED_CHARS = 64

LETTER, NUMBER, OTHER, SHORT_CONTRACTION, LONG_CONTRACTION, JOINED_SPACE, LAST_SPACE, SPACE, BREAK = range(9)
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, IN_SPACES, ONE_LEFT, TWO_LEFT = range(8)


def _rules() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a piece) by symbol and state."""
    to, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), np.uint8)
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER)):
        to[symbol] = state
        starts[symbol, [state, AFTER_SPACE]] = 0
    to[LETTER, [ONE_LEFT, TWO_LEFT]] = CLOSED, ONE_LEFT
    starts[LETTER, [ONE_LEFT, TWO_LEFT]] = 0
    for symbol, state in ((SHORT_CONTRACTION, ONE_LEFT), (LONG_CONTRACTION, TWO_LEFT)):
        to[symbol] = state
        to[symbol, [IN_OTHER, AFTER_SPACE]] = IN_OTHER
        starts[symbol, [IN_OTHER, AFTER_SPACE]] = 0
    to[JOINED_SPACE] = AFTER_SPACE
    to[LAST_SPACE] = CLOSED
    to[SPACE] = IN_SPACES
    starts[SPACE, IN_SPACES] = 0
    to[BREAK] = CLOSED
    return to, starts


def _monoid(generators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All compositions of the generators and the identity, and their multiplication table (first, then)."""
    found = {tuple(range(generators.shape[1])): 0}
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(int(g[s]) for s in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    maps = list(found)
    times = np.array([[found[tuple(g[s] for s in f)] for g in maps] for f in maps], np.uint16)
    return np.array(maps, np.uint8), times


TO, STARTS = _rules()
MAPS, TIMES = _monoid(TO)
_OF_SYMBOL = np.array([[tuple(m) for m in MAPS.tolist()].index(tuple(g)) for g in TO.tolist()], np.uint16)
_COLUMNS = 128


def _prefixes(f: np.ndarray) -> np.ndarray:
    """Inclusive prefix products of the monoid elements f."""
    k = len(MAPS)
    flat = TIMES.ravel()
    if len(f) <= _COLUMNS:
        shift = 1
        while shift < len(f):
            f = np.concatenate([f[:shift], flat[f[:-shift].astype(np.int64) * k + f[shift:]]])
            shift *= 2
        return f
    rows = -(-len(f) // _COLUMNS)
    block = np.zeros(rows * _COLUMNS, np.uint16)  # element 0 is the identity
    block[: len(f)] = f
    block = block.reshape(rows, _COLUMNS).T.copy()
    for j in range(1, _COLUMNS):
        block[j] = flat.take(block[j - 1].astype(np.int32) * k + block[j])
    before = np.zeros(rows, np.int32)
    before[1:] = _prefixes(block[-1])[:-1]
    block[:] = flat.take(before * k + block)
    return block.T.reshape(-1)[: len(f)]


def _classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of each codepoint, as the tiktoken library sees it."""
    import tiktoken

    points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, name in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        only = tiktoken.Encoding(f"class{name}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = bytes(only.encode_ordinary(points)).decode()
        out[np.frombuffer(matched.encode("utf-32-le"), np.uint32)] = name
    return out


def _symbols(points: np.ndarray, breaks: np.ndarray, classes: np.ndarray) -> np.ndarray:
    found = classes[points]
    found[breaks] = BREAK
    following = np.append(found[1:], np.uint8(BREAK))
    blank = found == SPACE
    last = blank & (following != SPACE) & (following != BREAK)
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        padded = np.append(points, np.zeros(2, np.uint32))
        one, two = padded[marks + 1], padded[marks + 2]
        short = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        found[marks[short]] = SHORT_CONTRACTION
        found[marks[long]] = LONG_CONTRACTION
    found[last] = LAST_SPACE
    found[last & (points == 0x20)] = JOINED_SPACE
    return found


def boundaries(points: np.ndarray, breaks: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions at which a piece starts; breaks: positions of separators, pieces of their own."""
    if not len(points):
        return np.zeros(0, np.int64)
    symbols = _symbols(points, breaks, classes)
    after = MAPS[:, CLOSED].take(_prefixes(_OF_SYMBOL[symbols]))
    before = np.empty_like(after)
    before[0] = CLOSED
    before[1:] = after[:-1]
    return np.flatnonzero(STARTS.ravel().take(symbols * np.int32(8) + before))


class _Merged(dict):
    """Piece to (ids, their decimal form); fills itself."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        super().__init__()
        # the pattern takes a whole piece, so only the merges are left to the library
        self.merge = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.ids = [*range(max(ranks.values()) + 1)]  # one object for each id

    def __missing__(self, piece: str):
        ids = tuple([self.ids[i] for i in self.merge(piece)])
        found = ids, " ".join(map(str, ids))
        if len(piece) <= CACHED_CHARS:
            self[piece] = found
        return found


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.bytes_of[rank] = piece
        lengths = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        self.size_of, self.at_of = lengths, np.cumsum(lengths) - lengths
        self.table = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.classes = _classes()
        self.merged = _Merged(self.ranks)

    def split(self, texts: list[str]) -> Iterator[list[str]]:
        """The pieces of each text."""
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(lengths + 1) - lengths - 1
        starts = boundaries(points, first[1:] - 1, self.classes)
        at = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(at, [*at[1:], len(joined)])]
        bounds = np.searchsorted(starts, [first, first + lengths]).tolist()
        for a, b in zip(*bounds):
            yield pieces[a:b]

    def merged_pieces(self, pieces: list[str]) -> list[tuple[tuple[int, ...], str]]:
        if len(self.merged) > CACHE_PIECES:
            self.merged.clear()
        return [*map(self.merged.__getitem__, pieces)]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of each text and the byte offset at which each id's bytes start."""
        for pieces in self.split(texts):
            ids = [*chain.from_iterable([x[0] for x in self.merged_pieces(pieces)])]
            yield ids, self.offsets(np.array(ids, np.int64)).tolist()

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each id's bytes start."""
        sizes = self.size_of[ids]
        return np.cumsum(sizes) - sizes

    def decode(self, ids: list[int], offsets: np.ndarray | None = None) -> bytes:
        """The ids' bytes, each laid where its offset says."""
        found = np.asarray(ids, np.int64)
        if not len(found):
            return b""
        if found.min() < 0:
            raise IndexError(f"no id {found.min()}")
        offsets = self.offsets(found) if offsets is None else offsets
        sizes = self.size_of[found]
        return self.table[np.repeat(self.at_of[found] - offsets, sizes) + np.arange(offsets[-1] + sizes[-1])].tobytes()


def _mapped(df: DataFrame, ranks: str, id_col: str, text_col: str, schema: str, rows_of) -> DataFrame:
    content, digest = shipped(df.sparkSession, ranks)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = once(digest, lambda: Codec(content.value))
        for rows in slices(batches, 1, BATCH_BYTES):
            yield rows_of(codec, rows)

    return df.select(df[id_col].alias("_id"), text_of(text_col).alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, {schema}")


def encode(df: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, offsets) of every row of df, in no order; no row is dropped.

    ranks: a rank file of tiktoken; pieces are the matches of the byte-level pattern
    with contractions, no special tokens. offsets: the byte of the text at which each
    id's bytes start. Null and empty texts give empty arrays, a null id and repeated
    rows stay, other columns of df are not read, an empty df gives an empty result.
    """

    def rows_of(codec: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [*codec.encode(rows.column(1).to_pylist())]
        return pa.record_batch([rows.column(0), pa.array([x[0] for x in found], pa.list_(pa.int32())), pa.array([x[1] for x in found], pa.list_(pa.int64()))], [id_col, "ids", "offsets"])

    return _mapped(df, ranks, id_col, text_col, "ids array<int>, offsets array<long>", rows_of)


def decode(df: DataFrame, ranks: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded binary) of every row of df; null ids give empty bytes, an id outside the ranks fails."""
    content, digest = shipped(df.sparkSession, ranks)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = once(digest, lambda: Codec(content.value))
        for rows in batches:
            yield pa.record_batch([rows.column(0), pa.array([codec.decode(ids or []) for ids in rows.column(1).to_pylist()], pa.binary())], [id_col, "decoded"])

    return df.select(df[id_col].alias("_id"), df[ids_col].alias("_ids")).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def round_trip_digests(df: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, with digests of both.

    Rows and edge cases as in encode(). Ids don't leave the worker unless with_ids adds
    them, so that a corpus of many tokens takes no more memory than its texts.
    """

    def rows_of(codec: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
        counts, ids_hex, decoded_hex, lists = [], [], [], []
        for pieces in codec.split(rows.column(1).to_pylist()):
            found = codec.merged_pieces(pieces)
            ids = np.fromiter(chain.from_iterable([x[0] for x in found]), np.int64)
            offsets = codec.offsets(ids)
            counts.append(len(ids))
            ids_hex.append(hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest())
            decoded_hex.append(hashlib.sha256(codec.decode(ids, offsets)).hexdigest())
            if with_ids:
                lists.append(ids.astype(np.int32))
        columns = [rows.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        return pa.record_batch([*columns, pa.array(lists, pa.list_(pa.int32()))] if with_ids else columns, [*names, "ids"] if with_ids else names)

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _mapped(df, ranks, id_col, text_col, schema, rows_of)
