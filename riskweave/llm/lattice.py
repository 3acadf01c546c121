"""Log-space forward recursion over the segmentations of words into vocabulary pieces."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

MARK = "▁"  # a word starts with it
LONGEST = 16  # characters of a piece that the lattice considers


@lru_cache(maxsize=2)
def existing_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[str, int], np.ndarray]:
    """Pieces of an existing SentencePiece model with their numbers, and the numbers of its 256 byte
    pieces. The proper prefixes of pieces are in the dictionary too, as -1."""
    model = existing_model(path)
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    odd, pieces = set(byte_ids.tolist()), {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if i not in odd and not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and len(piece) <= LONGEST:
            pieces[piece] = i
    for piece in list(pieces):
        for end in range(1, len(piece)):
            pieces.setdefault(piece[:end], -1)
    return pieces, byte_ids


class Trie:
    """Pieces as paths from node 0, walked for many positions at once. ``pieces`` holds their proper
    prefixes too. A step is looked up by node and character in an open-addressed table."""

    def __init__(self, pieces: dict[str, int]):
        number = {s: i for i, s in enumerate(sorted(pieces, key=len), 1)}
        number[""] = 0
        self.piece = np.array([-1] + [pieces[s] for s in number if s], np.int64)
        steps = np.array([number[s[:-1]] << 21 | ord(s[-1]) for s in number if s], np.int64)
        self.bits = max(4, int(len(steps)).bit_length() + 2)  # at most a quarter full
        self.keys, self.nodes = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        left, slot = np.arange(len(steps)), self._slot(steps)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = steps[left[free]]  # of those that want one slot the last gets it
            self.nodes[slot[free]] = left[free] + 1
            lost = self.keys[slot] != steps[left]
            left, slot = left[lost], (slot[lost] + 1) & (len(self.keys) - 1)

    def _slot(self, steps: np.ndarray) -> np.ndarray:
        return ((steps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The nodes reached by one more character; 0 where no piece goes on like this."""
        steps = node << 21 | code
        slot = self._slot(steps)
        out, left = np.zeros(len(steps), np.int64), np.arange(len(steps))
        while len(left):
            held = self.keys[slot]
            same = held == steps[left]
            out[left[same]] = self.nodes[slot[same]]
            on = ~same & (held >= 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


class Lattice:
    """Marginal probabilities of words for K score sets at once.

    ``logp`` has a row per piece and a column per score set. A character that is no piece is spelled
    by its byte pieces, so every word has a segmentation. Words of equal length are walked together,
    edge by edge; words over ``LONG`` characters are walked alone and hold only the last few values
    (for learning, those before every stretch of ``LONG``).
    """

    LONG = 256

    def __init__(self, pieces: dict[str, int], byte_ids: np.ndarray, logp: np.ndarray):
        self.pieces, self.byte_ids, self.logp, self.size = pieces, byte_ids, logp, len(logp)
        self.trie = Trie(pieces)
        self.spelled: dict[str, int] = {}
        self._room = logp  # holds ``logp`` and rows to spare

    def _spell(self, char: str) -> int:
        """Number of a row that scores ``char`` by its bytes."""
        at = self.spelled.get(char)
        if at is None:
            at = self.spelled[char] = len(self.logp)
            if at == len(self._room):
                self._room = np.vstack([self._room, np.empty((max(1024, at // 8), self.logp.shape[1]))])
            self._room[at] = self.logp[self._bytes(char)].sum(0)
            self.logp = self._room[: at + 1]
        return at

    def _bytes(self, char: str) -> np.ndarray:
        return self.byte_ids[list(char.encode("utf-8", "replace"))]

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """End, word, start and piece of every edge, by end and word, for words of one length."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        start = np.arange(len(codes))  # of the walks that still follow a piece, over all words joined
        room, node = n - start % n, np.zeros(len(codes), np.int64)
        starts, ends, found = [], [], []
        for k in range(1, min(n, LONGEST) + 1):
            node = self.trie.step(node, codes[start + k - 1])
            piece = self.trie.piece[node]
            if k == 1:
                bare = np.flatnonzero(piece < 0)
                chars, back = np.unique(codes[bare], return_inverse=True)
                piece[bare] = np.array([self._spell(chr(c)) for c in chars.tolist()], np.int64)[back]
            hit = piece >= 0
            starts.append(start[hit])
            ends.append(start[hit] + k)
            found.append(piece[hit])
            on = (node > 0) & (room > k)
            start, room, node = start[on], room[on], node[on]
        start, end, piece = (np.concatenate(x) for x in (starts, ends, found))
        word = start // n
        start, end = start - word * n, end - word * n
        order = np.argsort((end << 40) | (word << 16) | start)
        return end[order], word[order], start[order], piece[order]

    def forward(self, words: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """alpha[end, word, set]: log of the summed probability of all segmentations up to there, for
        words of one length; and their edges."""
        n, edges = len(words[0]), self.edges(words)
        end, word, start, piece = edges
        alpha = np.full((n + 1, len(words), self.logp.shape[1]), -np.inf)
        alpha[0] = 0
        bounds = np.searchsorted(end, np.arange(1, n + 2))
        for j in range(1, n + 1):
            e = slice(bounds[j - 1], bounds[j])
            runs = np.flatnonzero(np.append(True, word[e][1:] != word[e][:-1]))
            alpha[j, word[e][runs]] = np.logaddexp.reduceat(alpha[start[e], word[e]] + self.logp[piece[e]], runs, axis=0)
        return alpha, edges

    def _backward(self, edges: tuple[np.ndarray, ...], shape: tuple[int, ...]) -> np.ndarray:
        end, word, start, piece = edges
        beta = np.full(shape, -np.inf)
        beta[-1] = 0
        order = np.lexsort((word, start))
        bounds = np.searchsorted(start[order], np.arange(shape[0]))
        for i in range(shape[0] - 2, -1, -1):
            e = order[bounds[i] : bounds[i + 1]]
            if len(e):
                runs = np.flatnonzero(np.append(True, word[e][1:] != word[e][:-1]))
                beta[i, word[e][runs]] = np.logaddexp.reduceat(beta[end[e], word[e]] + self.logp[piece[e]], runs, axis=0)
        return beta

    def expected_counts(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations of each word, times its counts; a
        spelled character uses its byte pieces."""
        sets = self.logp.shape[1]
        total = np.zeros((self.size, sets))

        def add(piece: np.ndarray, use: np.ndarray) -> None:
            nonlocal total
            if len(self.logp) > len(total):  # characters spelled for the first time
                total = np.vstack([total, np.zeros((len(self.logp) - len(total), sets))])
            for z in range(sets):
                total[:, z] += np.bincount(piece, use[:, z], len(total))

        for at, lot in self._lots(words):
            alpha, edges = self.forward(lot)
            beta = self._backward(edges, alpha.shape)
            end, word, start, piece = edges
            share = np.exp(np.minimum(alpha[start, word] + self.logp[piece] + beta[end, word] - alpha[-1, word], 0))
            add(piece, share * counts[at][word])
        for i, w in enumerate(words):
            if len(w) > self.LONG:
                for piece, share in self._long_shares(w):
                    add(piece, share * counts[i])
        out = total[: self.size].copy()
        for char, row in self.spelled.items():
            if row < len(total):
                np.add.at(out, self._bytes(char), total[row])
        return out

    def _lots(self, words: list[str]):
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, at in by_length.items():
            if 0 < n <= self.LONG:
                step = max(1, min(2000, 40_000 // n))
                for k in range(0, len(at), step):
                    yield at[k : k + step], [words[i] for i in at[k : k + step]]

    def log_probability(self, words: list[str]) -> np.ndarray:
        """Marginal log probability of each word under each score set; an empty word has 0."""
        out = np.zeros((len(words), self.logp.shape[1]))
        for at, lot in self._lots(words):
            out[at] = self.forward(lot)[0][-1]
        for i, w in enumerate(words):
            if len(w) > self.LONG:
                out[i] = self._long(w)
        return out

    def _into(self, word: str, j: int) -> Iterator[tuple[int, int]]:
        """Length and piece of every edge that ends at ``j``."""
        for k in range(1, min(j, LONGEST) + 1):
            piece = self.pieces.get(word[j - k : j], -1)
            if piece >= 0:
                yield k, piece
            elif k == 1:
                yield k, self._spell(word[j - 1])

    def _walk(self, word: str, first: int, last: int, before: list[np.ndarray]) -> list[np.ndarray]:
        """alpha up to ``last``, from the values that end at ``first``."""
        alpha = list(before)
        for j in range(first + 1, last + 1):
            alpha.append(np.logaddexp.reduce([alpha[-k] + self.logp[p] for k, p in self._into(word, j)]))
        return alpha

    def _long(self, word: str) -> np.ndarray:
        last = [np.zeros(self.logp.shape[1])]
        for at in range(0, len(word), self.LONG):
            last = self._walk(word, at, min(at + self.LONG, len(word)), last)[-LONGEST:]
        return last[-1]

    def _long_shares(self, word: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces and their expected uses in one long word, stretch by stretch from its end. Only the
        values before each stretch are held; those inside it are walked again."""
        starts = list(range(0, len(word), self.LONG))
        before = [[np.zeros(self.logp.shape[1])]]
        for at in starts:
            before.append(self._walk(word, at, min(at + self.LONG, len(word)), before[-1])[-LONGEST:])
        whole = before.pop()[-1]
        beta = {len(word): np.zeros_like(whole)}
        for at, held in zip(reversed(starts), reversed(before)):
            end = min(at + self.LONG, len(word))
            alpha, pieces, shares = self._walk(word, at, end, held), [], []
            for j in range(end, at, -1):
                after = beta.pop(j)
                for k, piece in self._into(word, j):
                    step = self.logp[piece] + after
                    beta[j - k] = np.logaddexp(beta[j - k], step) if j - k in beta else step
                    pieces.append(piece)
                    shares.append(np.exp(np.minimum(alpha[len(held) - 1 + j - k - at] + step - whole, 0)))
            yield np.array(pieces, np.int64), np.array(shares)
