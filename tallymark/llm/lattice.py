"""Probability of words under a unigram vocabulary of pieces, over all their segmentations.

A word is a blank and its letters. Only its first piece may start with a blank, so the
probabilities of all words add up to one. A letter that is no piece stands for its bytes,
which are pieces too. ``forward`` adds up all segmentations in log space from left to
right, many words of one length at a time; ``expected`` gives how often each piece is
used over all of them, for one round of expectation maximisation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np

BLANK = "▁"
_BASE = np.uint64(0x100000001B3)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_BITS = 20
_INNER = 0x110000  # a blank within a word: no piece has it
CELLS = 2_000_000  # letters of the words worked on together


class Vocabulary:
    """The pieces of an existing vocabulary, by their scores' order."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        plain = [i for i in size if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in plain}
        usable = [p for p in pieces if BLANK not in p[1:]]
        self.pieces = sorted(usable, key=lambda p: (-pieces[p], p))
        self.longest = max(map(len, self.pieces))
        self.bytes_from = len(self.pieces)  # bytes follow the pieces
        self.size = self.bytes_from + 256
        self.hashes = np.array([_hash(_codes(p, True)) for p in self.pieces], np.uint64)
        self.first = np.full(1 << _BITS, -1, np.int32)
        self.second = np.full(1 << _BITS, -1, np.int32)
        spilled = []
        for table, odd, some in ((self.first, _ODD[0], range(len(self.pieces))), (self.second, _ODD[1], spilled)):
            slots = (self.hashes * odd) >> np.uint64(64 - _BITS)
            for i in some:
                at = int(slots[i])
                if table[at] < 0:
                    table[at] = i
                elif table is self.first:
                    spilled.append(i)
                else:
                    raise ValueError("two pieces share both of their slots")

    def by_rank(self) -> np.ndarray:
        """Probabilities that fall with the rank of the scores, as word frequencies do; bytes share one thousandth."""
        weights = 1.0 / (np.arange(self.bytes_from) + 2.7)
        return np.concatenate((weights / weights.sum() * 0.999, np.full(256, 0.001 / 256)))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``hashes`` holds a piece's hash, and the number of the piece. Few do, so all else ends at one look-up."""
        where, found = [], []
        for table, odd in zip((self.first, self.second), _ODD):
            at = table[(hashes * odd) >> np.uint64(64 - _BITS)]
            some = np.flatnonzero(at >= 0)
            some = some[self.hashes[at[some]] == hashes[some]]
            where.append(some)
            found.append(at[some])
        return np.concatenate(where), np.concatenate(found)


def _codes(word: str, piece: bool = False) -> np.ndarray:
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return codes if piece else np.where(codes == ord(BLANK), np.uint64(_INNER), codes)


def _hash(codes: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in codes:
            h = h * _BASE + c + np.uint64(1)
    return h


class Lattice:
    def __init__(self, vocabulary: Vocabulary, probabilities: np.ndarray):
        self.vocabulary = vocabulary
        with np.errstate(divide="ignore"):
            self.log = np.log(probabilities)

    def _arcs(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """For each letter the arcs that end there: start, words that have it, piece numbers, log probabilities.

        ``codes`` is (words, letters). A letter that is no piece has an arc with number -1.
        """
        n, letters = codes.shape
        rolled = np.zeros((letters + 1, n), np.uint64)
        for j in range(letters):
            rolled[j + 1] = rolled[j] * _BASE + codes[:, j] + np.uint64(1)
        longest = min(self.vocabulary.longest, letters)
        power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(longest + 1)], np.uint64)
        out = []
        for j in range(1, letters + 1):
            ends = []
            for k in range(1, min(j, longest) + 1):
                words, number = self.vocabulary.find(rolled[j] - rolled[j - k] * power[k])
                if len(words):
                    ends.append((j - k, words, number, self.log[number]))
                if k == 1 and len(words) < n:
                    alone = np.ones(n, bool)
                    alone[words] = False
                    alone = np.flatnonzero(alone)
                    kinds, which = np.unique(codes[alone, j - 1], return_inverse=True)
                    value = np.array([self._bytes(int(c)) for c in kinds])[which]
                    ends.append((j - 1, alone, np.full(len(alone), -1, np.int32), value))
            out.append(ends)
        return out

    def _byte_numbers(self, code: int) -> list[int]:
        text = BLANK if code == _INNER else chr(code)
        return [self.vocabulary.bytes_from + b for b in text.encode("utf-8", "surrogatepass")]

    def _bytes(self, code: int) -> float:
        return float(sum(self.log[i] for i in self._byte_numbers(code)))

    def _sweep(self, arcs: list, n: int) -> np.ndarray:
        """(letters + 1, words) log probabilities of all ways to each position."""
        alpha = np.full((len(arcs) + 1, n), -np.inf)
        alpha[0] = 0
        for j, ends in enumerate(arcs, 1):
            for start, words, _, value in ends:
                alpha[j, words] = np.logaddexp(alpha[j, words], alpha[start, words] + value)
        return alpha

    def forward(self, words: list[str]) -> np.ndarray:
        """Natural log probability of each word."""
        out = np.zeros(len(words))
        for some, codes in _batches(words):
            if codes is None:
                out[some[0]] = self._long(words[some[0]])
            else:
                out[some] = self._sweep(self._arcs(codes), len(codes))[-1]
        return out

    @cached_property
    def _pieces(self) -> dict[str, float]:
        return {p: float(self.log[i]) for i, p in enumerate(self.vocabulary.pieces)}

    def _long(self, word: str) -> float:
        """The same recursion for one word of any length."""
        number = self._pieces
        text = BLANK + word.replace(BLANK, chr(0x10FFFF))  # inner blanks: no piece has them either
        ways = [0.0]
        for j in range(1, len(text) + 1):
            arcs = [
                ways[i] + number[text[i:j]] for i in range(max(0, j - self.vocabulary.longest), j) if text[i:j] in number
            ]
            if text[j - 1] not in number:
                code = ord(text[j - 1])
                arcs.append(ways[j - 1] + self._bytes(_INNER if code == 0x10FFFF else code))
            top = max(arcs)
            ways.append(top + float(np.log(np.exp(np.array(arcs) - top).sum())))
        return ways[-1]

    def expected(self, words: list[str]) -> np.ndarray:
        """How often each piece and byte is used in the words, averaged over their segmentations."""
        total = np.zeros(self.vocabulary.size)
        batches = ((codes, None) for some, codes in _batches(words) if codes is not None)
        for codes, own in chain(batches, *(_windows(word) for word in words if len(word) > LONG)):
            arcs = self._arcs(codes)
            alpha = self._sweep(arcs, len(codes))
            beta = np.full_like(alpha, -np.inf)
            beta[-1] = 0
            for j in range(len(arcs), 0, -1):
                for start, words_, number, value in arcs[j - 1]:
                    onward = value + beta[j, words_]
                    used = np.exp(alpha[start, words_] + onward - alpha[-1, words_])
                    if own is not None:
                        used = used * ((own[0][words_] < j) & (j <= own[1][words_]))
                    beta[start, words_] = np.logaddexp(beta[start, words_], onward)
                    if number[0] >= 0:
                        total += np.bincount(number, used, self.vocabulary.size)
                        continue
                    for w, u in zip(words_.tolist(), used.tolist()):
                        for b in self._byte_numbers(int(codes[w, j - 1])):
                            total[b] += u
        return total


LONG = 400  # letters; beyond it a word is scored alone, and fitted window by window
OVERLAP = 64  # letters that two windows share


def _windows(word: str) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """A long word as windows of ``LONG`` letters, and the letters of each at which what ends counts: each once."""
    codes = np.frombuffer((BLANK + word).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes[1:][codes[1:] == ord(BLANK)] = _INNER
    n = len(codes)
    starts = np.append(np.arange(0, n - LONG, LONG - OVERLAP), n - LONG)
    low = np.concatenate(([0], starts[1:] + OVERLAP // 2))
    high = np.append(low[1:], n)
    step = max(1, CELLS // (LONG * 16))
    for at in range(0, len(starts), step):
        some = starts[at:at + step]
        yield codes[some[:, None] + np.arange(LONG)], (low[at:at + step] - some, high[at:at + step] - some)


def _batches(words: list[str]) -> Iterator[tuple[list[int], np.ndarray | None]]:
    """Words of one length together, each with a blank in front; a very long word alone, without codes."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, which in by_length.items():
        if length > LONG:
            yield from (([i], None) for i in which)
            continue
        step = max(1, CELLS // ((length + 1) * 16))
        for at in range(0, len(which), step):
            some = which[at:at + step]
            codes = np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le", "surrogatepass"), "<u4")
            codes = codes.reshape(len(some), length).astype(np.uint64)
            codes[codes == ord(BLANK)] = _INNER
            yield some, np.concatenate((np.full((len(some), 1), ord(BLANK), np.uint64), codes), axis=1)


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per path and process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]
