"""Token counts by a deterministic transducer compiled from a merge vocabulary.

The vocabulary merges neighbours, best score first, wherever their concatenation is a
piece. For such a rule a row of pieces is the encoding of its text exactly when each
neighbouring two are the encoding of theirs, and the encoding of every prefix ends in
one piece. So a state need only hold, for each start from which a longer piece may still
come, the node of the piece trie, the piece before it, and how many pieces lead there;
the emission of a step is the change in the number of pieces of the prefix. Steps from
known states are table look-ups; a step not seen before is worked out once and entered.

Two characters that no piece holds side by side always part, so the state is reset
there. A text is cut into equal chunks that run side by side, each from its first reset;
what a chunk does to the state that enters it is then a head to run from that state, a
count, and a fixed state at the end; a chunk without a reset is all head. A prefix scan
composes these maps, and then all heads run side by side.

The table is bounded. Text that needs more of it, say of thousands of different letters,
is cut at resets until its parts fit a fresh one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np

BLANK = "▁"
STATES, CELLS = 200_000, 40_000_000  # of the transition table, which never grows beyond them
BUSHY = 6  # children of a trie node from which on a longer piece is taken to be possible
CHUNK = 512
GROUP = 2_000_000  # code points that run together
PAIRS = 500_000  # remembered answers of either kind
WORDS = 100_000  # remembered words after a run of blanks
START = 0


class Full(Exception):
    """The transition table would outgrow its bounds."""


class Transducer:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.normalize("ａ  b ") != f"{BLANK}ａ{BLANK}{BLANK}b{BLANK}":
            raise ValueError("only vocabularies that keep the text as it is, after one blank in front, are supported")
        ordinary = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ordinary}
        if any(BLANK in p.lstrip(BLANK) or (p.startswith(BLANK * 2) and p.strip(BLANK)) for p in self.score):
            raise ValueError("only vocabularies whose blanks lead a piece are supported")
        words = [p for p in self.score if not p.startswith(BLANK * 2)]
        self.letters = {c: i + 1 for i, c in enumerate(sorted({c for p in words for c in p}))}
        size = len(self.letters) + 1  # letter 0: in no piece
        self.number = np.zeros(0x110000, np.int32)
        for c, i in self.letters.items():
            self.number[ord(c)] = i
        self.number[32] = self.number[ord(BLANK)]
        self.blank = int(self.number[32])
        self.joined = np.zeros((size, size), bool)
        for p in words:
            for a, b in zip(p, p[1:]):
                self.joined[self.letters[a], self.letters[b]] = True
        # The trie: children by node and letter, and the piece that ends at a node. A letter that is no piece stands
        # for its bytes.
        self.child: list[dict[int, int]] = [{}]
        self.piece: list[str] = [""]
        for p in [*words, *(c for c in self.letters if c not in self.score)]:
            node = 0
            for c in p:
                node = self.child[node].setdefault(self.letters[c], len(self.child))
                if node == len(self.child):
                    self.child.append({})
                    self.piece.append("")
            self.piece[node] = p
        self.pairs: dict[tuple[str, str], bool] = {}
        self.leads: dict[tuple[str, int], bool] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, float]]] = {}
        # Whether every piece comes after its parts, as in vocabularies that were learned merge by merge.
        self.ordered = all(
            final is None or all(len(x) == 1 or self.score[x] >= self.score[p] for x in final)
            for p in words for _, final in [self._merged(p)]
        )
        self.after_blanks: dict[str, int] = {}
        self._clear()

    # ---- the merge rule itself, for single words

    def merge(self, text: str) -> list[str]:
        """The pieces of ``text`` by the rule: best score first, then leftmost."""
        return self._merged(text)[0]

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces of ``text`` and the two parts of the last merge."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, str]] = []
        final = None

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.score:
                    heapq.heappush(queue, (-self.score[both], i, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = right[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
                continue
            final = (parts[i], parts[j])
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None], final

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """The parts that stand at one edge of a piece while it is merged, each with when it is merged away."""
        found = self.edges.get((piece, side))
        if found is None:
            if len(piece) == 1:
                found = [(piece, math.inf)]
            else:
                pieces, final = self._merged(piece)
                if pieces != [piece]:
                    found = []  # the rule never makes this piece
                else:
                    inner = self._edge(final[side], side)
                    found = [*inner[:-1], (inner[-1][0], -self.score[piece]), (piece, math.inf)]
            self.edges[piece, side] = found
        return found

    def weight(self, piece: str) -> int:
        """Tokens of a piece: one, or its bytes if it is none."""
        return 1 if piece in self.score else len(piece.encode())

    # ---- states

    def _clear(self) -> None:
        self.classes = np.zeros(len(self.letters) + 1, np.int32)  # of letters, as they occur; 0 stands still
        self.letter_of = [0]
        self.states: list[tuple] = [((0, "", 0),)]
        self.number_of: dict[tuple, int] = {self.states[0]: START}
        self.next = np.full((1024, 64), -1, np.int32)
        self.emit = np.zeros((1024, 64), np.int8)
        self.next[:, 0] = np.arange(1024)

    def _grow(self, states: int, classes: int) -> None:
        rows, columns = self.next.shape
        while states > rows:
            rows *= 2
        while classes > columns:
            columns *= 2
        if states > STATES or rows * columns > CELLS:
            raise Full
        if (rows, columns) == self.next.shape:
            return
        after, emit = np.full((rows, columns), -1, np.int32), np.zeros((rows, columns), np.int8)
        after[: self.next.shape[0], : self.next.shape[1]] = self.next
        emit[: self.next.shape[0], : self.next.shape[1]] = self.emit
        after[:, 0] = np.arange(rows)
        self.next, self.emit = after, emit

    def _apart(self, a: str, b: str) -> bool:
        """Whether pieces ``a`` and ``b`` side by side are the encoding of their text.

        They are unless, at some time of their own merges, the part at the end of ``a`` and
        the one at the start of ``b`` make a piece that is due before either is merged away.
        """
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self._stays_apart(a, b)
        return found

    def _stays_apart(self, a: str, b: str) -> bool:
        starts = self._edge(b, 0)
        if not a or not starts:
            return bool(starts)
        if not self.ordered:
            return self.merge(a + b) == [a, b]
        ends, i, j = self._edge(a, 1), 0, 0
        while True:
            (x, x_gone), (y, y_gone) = ends[i], starts[j]
            score = self.score.get(x + y)
            if score is not None and -score < x_gone and -score <= y_gone:
                return False
            if x_gone == y_gone == math.inf:
                return True
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1

    def _leads(self, before: str, node: int) -> bool:
        """Whether a longer piece that starts with this node's letters may follow ``before``.

        Wrongly saying so costs a state, nothing else, so nodes with many children are not searched.
        """
        if len(self.child[node]) > BUSHY:
            return True
        found = self.leads.get((before, node))
        if found is None:
            if len(self.leads) > PAIRS:
                self.leads.clear()
            found = self.leads[before, node] = any(
                (self.piece[down] and self._apart(before, self.piece[down])) or self._leads(before, down)
                for down in self.child[node].values()
            )
        return found

    def _after(self, state: tuple, letter: int) -> tuple[tuple, int]:
        """The state after a letter, and the change in the number of tokens."""
        after, last, total = [], "", 0
        for node, before, count in state:
            down = self.child[node].get(letter)
            if down is None:
                continue
            piece = self.piece[down]
            if piece and self._apart(before, piece):
                last, total = piece, count + self.weight(piece)
            if self._leads(before, down):
                after.append((down, before, count))
        return (*((node, before, count - total) for node, before, count in after), (0, last, 0)), total

    def _step(self, state: int, column: int) -> None:
        """Work out a step that the table does not hold yet, and enter it."""
        key, total = self._after(self.states[state], self.letter_of[column])
        number = self.number_of.get(key)
        if number is None:
            self._grow(len(self.states) + 1, 0)
            number = self.number_of[key] = len(self.states)
            self.states.append(key)
        self.next[state, column], self.emit[state, column] = number, total

    # ---- runs over many texts

    def counts(self, texts: Iterable[str]) -> Iterator[int]:
        """The number of tokens of each text, in order."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text) + 2
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[int]:
        if not texts:
            return
        # Each text stands between its leading blank and a letter of no piece.
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths + 2) - lengths - 2
        codes = np.frombuffer("".join([f" {t}\0" for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4")
        letters = self.number[codes]
        emitted = self._run(letters, codes)
        unknown = letters == 0
        emitted[unknown] = _byte_lengths(codes[unknown])
        emitted[starts + lengths + 1] = 0
        totals = np.add.reduceat(emitted, starts)
        totals[lengths == 0] = 0
        yield from totals.tolist()

    def _run(self, letters: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What each letter emits; runs of blanks and the words after them are settled whole."""
        n = len(letters)
        reset = np.ones(n, bool)
        reset[1:] = ~self.joined[letters[:-1], letters[1:]]
        emitted = np.zeros(n, np.int64)
        still = letters == 0
        blank = letters == self.blank
        doubled = np.flatnonzero(blank[1:] & blank[:-1])  # a blank and another after it
        if len(doubled):
            first = doubled[np.concatenate(([True], np.diff(doubled) > 1))]
            resets = np.flatnonzero(reset)
            others = np.flatnonzero(~blank)
            word = others[np.searchsorted(others, first)]  # the letter after the run; a text's end is one
            stop = resets[np.searchsorted(resets, word, "right")] if len(resets) else np.full(len(word), n)
            stop = np.where(reset[word] | still[word], word, stop)
            for a, b in zip(first.tolist(), stop.tolist()):
                emitted[a] = self._after_blanks(codes[a:b])
                still[a:b] = True
                reset[b:b + 1] = True
        self._span(np.where(still, 0, letters), reset | still, emitted, 0, n)
        return emitted

    def _span(self, letters: np.ndarray, resets: np.ndarray, emitted: np.ndarray, low: int, high: int) -> None:
        """The steps from ``low``, where the state is fresh, up to ``high``.

        Where they outgrow the table, it starts anew; a span too rich for a fresh one is cut in two at a
        reset, and one without any is worked out letter by letter beside the table.
        """
        for _ in range(2):
            try:
                emitted[low:high] += self._chunks(self._columns(letters[low:high]), resets[low:high])
                return
            except Full:
                self._clear()
        cuts = np.flatnonzero(resets[low + 1:high]) + low + 1
        if len(cuts):
            middle = int(cuts[min(np.searchsorted(cuts, (low + high) // 2), len(cuts) - 1)])
            self._span(letters, resets, emitted, low, middle)
            self._span(letters, resets, emitted, middle, high)
            return
        state = self.states[START]
        for i, letter in enumerate(letters[low:high].tolist(), low):
            if letter:
                state, total = self._after(state, letter)
                emitted[i] += total

    def _columns(self, letters: np.ndarray) -> np.ndarray:
        """The table's columns of the letters; letter 0 stands still."""
        there = np.unique(letters)
        for c in there[(there > 0) & (self.classes[there] == 0)].tolist():
            self._grow(0, len(self.letter_of) + 1)
            self.classes[c] = len(self.letter_of)
            self.letter_of.append(c)
        return self.classes[letters]

    def _after_blanks(self, codes: np.ndarray) -> int:
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").replace(" ", BLANK)
        found = self.after_blanks.get(text)
        if found is None:
            if len(self.after_blanks) >= WORDS:
                self.after_blanks.clear()
            found = self.after_blanks[text] = sum(map(self.weight, self.merge(text)))
        return found

    def _chunks(self, columns: np.ndarray, reset: np.ndarray) -> np.ndarray:
        """What each letter emits. Chunks run side by side, then the heads of all chunks do."""
        n = len(columns)
        lanes = -(-n // CHUNK)
        grid = np.zeros(lanes * CHUNK, np.int32)
        grid[:n] = columns
        turn = np.zeros(lanes * CHUNK, bool)
        turn[:n] = reset
        grid, turn = grid.reshape(lanes, CHUNK), turn.reshape(lanes, CHUNK)
        has = turn.any(axis=1)
        head = np.where(has, turn.argmax(axis=1), CHUNK)
        # The steps from each chunk's first reset on, all chunks side by side.
        run = grid.T.copy()
        run[np.arange(CHUNK)[:, None] < head[None, :]] = 0
        turns = np.ascontiguousarray(turn.T)
        out = np.zeros((CHUNK, lanes), np.int8)
        state = np.zeros(lanes, np.int32)
        for t in range(CHUNK):
            column = run[t]
            state[turns[t]] = START
            out[t], state = self._stepped(state, column)
        emitted = out.T.reshape(-1)[:n].astype(np.int64)
        # The maps compose by a prefix scan. A chunk with a reset maps all that enters it to one state, so the scan
        # carries the last such chunk on; what enters a chunk is that one's state, run over the letters in between.
        last = np.maximum.accumulate(np.where(has, np.arange(lanes), -1))
        heads = np.flatnonzero(head > 0)
        before = np.where(heads > 0, last[heads - 1], -1)
        opens = (heads == 0) | has[heads - 1]  # a head that goes on from one before it is part of that one
        first = heads[opens]
        now = np.where(before[opens] >= 0, state[before[opens]], START).astype(np.int32)
        ends = np.append(np.flatnonzero(has), lanes)
        until = ends[np.searchsorted(ends, first)]
        stop = np.minimum(until * CHUNK + np.append(head, 0)[until], n)
        at = first * CHUNK
        while len(at):
            going = at < stop
            at, now, stop = at[going], now[going], stop[going]
            emitted[at], now = self._stepped(now, columns[at])
            at = at + 1
        return emitted

    def _stepped(self, state: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each pair of state and letter emits, and the state after it."""
        after = self.next[state, column]
        if len(after) and after.min() < 0:
            after = self._missing(state, column, after)
        return self.emit[state, column], after

    def _missing(self, state: np.ndarray, column: np.ndarray, after: np.ndarray) -> np.ndarray:
        unknown = np.flatnonzero(after < 0)
        for pair in np.unique(state[unknown].astype(np.int64) << 32 | column[unknown]).tolist():
            self._step(pair >> 32, pair & 0xFFFFFFFF)
        return self.next[state, column]


def _byte_lengths(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One transducer per path and Python worker, so what it has compiled serves all its tasks."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]
