"""Token ids of whole texts from a vocabulary whose pre-tokenizer never looks across white space.

Texts are cut at ASCII white space and each distinct word is encoded once; ids are kept
as little-endian unsigned 32-bit bytes, so a text's ids are one join. Words of printable
ASCII and accented Latin letters, all but a few, are encoded together: their parts go
through the rank merges of a byte-level encoder whose ranks are the vocabulary's merge
order, with a byte 0 as the word end. Any other word, and any text that holds a special
token's string, goes to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import tiktoken

CACHED = 500_000  # words; beyond it the cache starts anew
LONG = 256  # bytes; longer words are encoded but not kept
GROUP = 4_000_000  # bytes of text whose new words are encoded together

# Fixed value: the pre-tokenizer's pattern, for lower-cased words of the letters above; a line feed parts words.
_PARTS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, end = _byte_letters(), model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            body = token.removesuffix(end)
            return bytes(letters[c] for c in body) + b"\0" * (token != body)

        # A letter with its word end comes before all merges; then the merges in their order.
        order = [bytes([b]) for b in range(256)]
        order += [bytes([b, 0]) for b in range(1, 256)]
        order += [raw("".join(pair)) for pair in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        order = list(dict.fromkeys(t for t in order if b"\0" not in t[:-1]))
        known = {raw(t): i for t, i in model["vocab"].items() if set(t.removesuffix(end)) <= letters.keys()}
        self.ids_of = np.array([known.get(t, 0) for t in order], np.uint32)
        self.ends = np.array([t[-1] == 0 for t in order])
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks={t: i for i, t in enumerate(order)}, special_tokens={}
        )

    def _together(self, words: list[str]) -> Iterator[bytes]:
        parts = _PARTS.findall("\n".join(words).lower())
        pieces = [p for p in parts if p != "\n"]
        found = np.array(self.merges.encode_ordinary("\0".join(pieces) + "\0"), np.int64)
        stops = np.flatnonzero(self.ends[found]) + 1  # after each part
        counts = np.diff([-1, *(i for i, p in enumerate(parts) if p == "\n"), len(parts)]) - 1  # parts of each word
        bounds = np.concatenate(([0], stops[np.cumsum(counts) - 1])) * 4
        data = self.ids_of[found].astype("<u4").tobytes()
        return (data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))

    def _learn(self, new: list[bytes]) -> None:
        plain, other = [], []
        for word in new:
            (plain if _PLAIN.fullmatch(word.decode()) else other).append(word)
        if plain:
            self.cache.update(zip(plain, self._together([w.decode() for w in plain])))
        if other:
            found = self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)
            self.cache.update(zip(other, (np.array(e.ids, "<u4").tobytes() for e in found)))

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        folded = [t.lower() for t in texts]  # the vocabulary folds case anyway
        words = [t.split() for t in folded]
        used = set().union(*words)
        if len(self.cache) + len(used) > CACHED:
            self.cache = {w: self.cache[w] for w in used if w in self.cache}
        self._learn([w for w in used if w not in self.cache])
        cache = self.cache
        for text, low, parts in zip(texts, folded, words):
            if any(mark in low for mark in self.special):
                yield np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield b"".join([cache[w] for w in parts])
        for word in used:
            if len(word) > LONG:
                del cache[word]

    def ids(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One encoder per path and Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
