"""Byte-level BPE with pre-tokens found by a scan of transition functions, without a pattern matcher.

Each code point falls into a class that already knows its neighbours (white space before
white space, an apostrophe before a contraction's letters). A class is a function from
state to state; functions compose, so the text is cut into chunks whose composed
functions are joined by a parallel prefix scan, and every chunk then runs again from the
state that truly enters it, marking where a pre-token starts. All of it is array work on
many texts at once. The slices feed a cache of merged pieces.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

CHUNK = 256
GROUP = 2_000_000  # code points scanned together
CACHED = 300_000  # pieces; beyond it the cache starts anew
LONG = 200  # characters; longer slices are merged but not kept

# Classes. A space right before other than white space belongs to what follows (LEAD); other white space right
# before something else stands alone (ALONE); white space before white space or the end is part of a run (RUN).
END, LETTER, NUMBER, OTHER, SHORT, TWO, LEAD, ALONE, RUN = range(9)
# States: nothing open, after a leading space, within letters, numbers, others or white space, and with one or two
# letters of a contraction to come.
FRESH, LED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_RUN, ONE_LEFT, TWO_LEFT = range(8)

# The letters after an apostrophe that make a contraction.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a pre-token starts, by class and state."""
    after, start = np.zeros((9, 8), np.int8), np.ones((9, 8), bool)

    def rule(kind: int, to: int, joins: dict[int, int]) -> None:
        after[kind] = to
        for state, then in joins.items():
            after[kind, state], start[kind, state] = then, False

    rule(LETTER, IN_LETTERS, {LED: IN_LETTERS, IN_LETTERS: IN_LETTERS, ONE_LEFT: FRESH, TWO_LEFT: ONE_LEFT})
    rule(NUMBER, IN_NUMBERS, {LED: IN_NUMBERS, IN_NUMBERS: IN_NUMBERS})
    rule(OTHER, IN_OTHERS, {LED: IN_OTHERS, IN_OTHERS: IN_OTHERS})
    rule(SHORT, ONE_LEFT, {LED: IN_OTHERS, IN_OTHERS: IN_OTHERS})
    rule(TWO, TWO_LEFT, {LED: IN_OTHERS, IN_OTHERS: IN_OTHERS})
    rule(LEAD, LED, {})
    rule(ALONE, FRESH, {})
    rule(RUN, IN_RUN, {IN_RUN: IN_RUN})
    rule(END, FRESH, {})
    return after, start


AFTER, STARTS = _tables()
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Letter, number, white space (as LEAD) or other of each code point; made once per process."""
    if not _KINDS:
        kinds = np.full(0x110000, OTHER, np.int8)
        for c in range(0x110000):
            group = unicodedata.category(chr(c))[0]
            if group in "LN":
                kinds[c] = LETTER if group == "L" else NUMBER
            elif group == "Z" or 9 <= c <= 13 or c == 0x85:
                kinds[c] = LEAD
        _KINDS.append(kinds)
    return _KINDS[0]


def classes(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each code point; ``ends`` are the positions of the marks after each text."""
    kind = _kinds()[codes].copy()
    kind[ends] = END
    white = np.flatnonzero(kind == LEAD)
    following = kind[white + 1]  # every text ends in a mark
    kind[white] = np.where(
        (following == LEAD) | (following == END), RUN, np.where(codes[white] == 32, LEAD, ALONE)
    )
    quotes = np.flatnonzero(codes == 39)
    quotes = quotes[kind[quotes] == OTHER]
    padded = np.concatenate((codes, [0, 0]))
    first, second = padded[quotes + 1], padded[quotes + 2]
    two = np.zeros(len(quotes), bool)
    for a, b in TWO_LETTERS:
        two |= (first == ord(a)) & (second == ord(b))
    kind[quotes[two]] = TWO
    kind[quotes[np.isin(first, [ord(c) for c in ONE_LETTER])]] = SHORT
    return kind


def starts(kind: np.ndarray) -> np.ndarray:
    """Where a pre-token (or the mark after a text) starts, by a prefix scan over chunks of transition functions."""
    n = len(kind)
    lanes = -(-n // CHUNK)
    grid = np.full(lanes * CHUNK, END, np.int8)
    grid[:n] = kind
    steps = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T).astype(np.intp) * 8
    after, start = AFTER.reshape(-1).astype(np.intp), STARTS.reshape(-1)
    # What each chunk does to each state. A chunk is run from all states until they have all met.
    maps = np.tile(np.arange(8), (lanes, 1))
    open_ = np.arange(lanes)
    met = np.empty(lanes, np.intp)
    for t in range(CHUNK):
        maps[open_] = after[steps[t, open_, None] + maps[open_]]
        same = (maps[open_] == maps[open_, :1]).all(axis=1)
        if same.any():
            met[open_[same]] = t + 1
            open_ = open_[~same]
            if not len(open_):
                break
    met[open_] = CHUNK
    for t in range(int(met.min()) if lanes else CHUNK, CHUNK):
        single = met <= t
        maps[single] = after[steps[t, single] + maps[single, 0]][:, None]
    # Compose the maps of all chunks up to each one, twice as many with every round.
    reach = 1
    while reach < lanes:
        if (maps[1:] == maps[1:, :1]).all():
            break  # constant functions: what came before no longer matters
        earlier = maps[:-reach]
        maps[reach:] = np.take_along_axis(maps[reach:], earlier, axis=1)
        reach *= 2
    state = np.concatenate(([FRESH], maps[:-1, FRESH])) if lanes else np.zeros(0, np.intp)
    out = np.empty((CHUNK, lanes), bool)
    for t in range(CHUNK):
        at = steps[t] + state
        out[t] = start[at]
        state = after[at]
    return out.T.reshape(-1)[:n]


class BytePairs:
    """Encoder and decoder for a file of ranks (``base64 rank`` per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        self.pieces = [b""] * size
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        # Pair merging alone: its pattern takes any slice as it is.
        self.merges = tiktoken.Encoding("slices", pat_str=r"(?s:.+)", mergeable_ranks=self.ranks, special_tokens={})
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.cache: dict[str, bytes] = {}

    def _merged(self, piece: str) -> bytes:
        ids = np.array(self.merges.encode_ordinary(piece), "<u4").tobytes()
        if len(piece) <= LONG:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order, as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text) + 1
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        whole = "\0".join(texts) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        cuts = np.flatnonzero(starts(classes(codes, ends)))
        bounds = np.searchsorted(cuts, ends)  # a text's mark is a cut of its own
        cuts, cache, first = cuts.tolist(), self.cache, 0
        for last in bounds.tolist():
            found = []
            for a, b in zip(cuts[first:last], cuts[first + 1:last + 1]):
                piece = whole[a:b]
                found.append(cache.get(piece) or self._merged(piece))
            first = last + 1
            yield b"".join(found)

    def offsets(self, ids: bytes) -> np.ndarray:
        """The byte at which each token starts, and the length of the whole."""
        return np.concatenate(([0], np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])))

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


_LOADED: dict[str, BytePairs] = {}


def byte_pairs(path: str) -> BytePairs:
    """One encoder per path and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """``(doc_id, ids, offsets)`` of every row: token ids, and the byte where each starts, then the text's length.

    A null or empty text has no ids and the one offset 0. Rows with equal or null ids each come back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0), pairs.encode(t or "" for t in batch.column(1).to_pylist())):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id.as_py()], pa.int64()),
                        pa.array([np.frombuffer(ids, "<u4").astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([pairs.offsets(ids)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "ids", "offsets"],
                )

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``(doc_id, bytes)`` of rows of ``(doc_id, ids)``; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks)
        for batch in batches:
            found = [None if i is None else pairs.decode(np.array(i, "<u4").tobytes()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, ranks: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded and decoded again within one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for ids in pairs.encode(t or "" for t in batch.column(1).to_pylist()):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
