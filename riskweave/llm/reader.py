"""A bidirectional gated recurrent reader with attention pooling, in numpy."""

from __future__ import annotations

from zlib import crc32

import numpy as np

from riskweave.llm.common import give_back

SPAN = 12  # words of a window
STRIDE = 4  # windows start at every 4th word, so neighbours share eight words
HIDDEN = 8
WORD_SIZE = 12
CHAR_SIZE = 12
ATTENTION = 8
GRAMS = (3, 5)
BUCKETS = 8192
CACHED = 300_000
LIMIT = 12.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def char_buckets(words: list[str], buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hash buckets of the character n-grams of ``^word$``: for each n the buckets in word order, the
    words that have any, and how many each of these has."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes).astype(np.int32), sizes)
    out = []
    for n in GRAMS:
        h = np.full(max(0, len(codes) - n + 1), n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = h[np.arange(n, n + len(h), dtype=np.int32) <= ends[: len(h)]]
        h >>= np.uint64(11)
        h %= np.uint64(buckets)
        count = np.maximum(sizes - n + 1, 0)
        some = np.flatnonzero(count)
        out.append((h.view(np.int64), some, count[some]))
    return out


def sum_rows(rows: np.ndarray, into: np.ndarray, at: np.ndarray) -> None:
    """``into[at] += rows``, where ``at`` may repeat."""
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        into[at[heads]] += np.add.reduceat(rows[order], heads, axis=0)


def windows_of(count: int) -> np.ndarray:
    """Word positions of every window of a text, -1 beyond its end; an empty text has one."""
    starts = np.arange(0, max(1, count - SPAN + STRIDE), STRIDE)
    at = starts[:, None] + np.arange(SPAN)
    return np.where(at < count, at, -1)


class Reader:
    """Logit of a window of words. A word enters by its own embedding, if it was seen often enough
    in training, and by the mean embedding of its character n-grams."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 7):
        rng = np.random.default_rng(seed)
        size, wide = WORD_SIZE + CHAR_SIZE, 3 * HIDDEN
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "word": (rng.normal(0, 0.1, (len(vocabulary) + 1, WORD_SIZE))).astype(np.float32),
            "char": (rng.normal(0, 0.5, (BUCKETS, CHAR_SIZE))).astype(np.float32),
            "at": draw(2 * HIDDEN, ATTENTION), "ab": np.zeros(ATTENTION, np.float32), "av": draw(ATTENTION),
            "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32),
        }
        for d in "fb":
            self.p |= {f"w{d}": draw(size, wide), f"u{d}": draw(HIDDEN, wide), f"c{d}": np.zeros(wide, np.float32)}

    def lookup(self, words: list[str]):
        """Vocabulary row and character n-grams of each word."""
        return np.array([self.vocabulary.get(w, len(self.vocabulary)) for w in words], np.int64), char_buckets(words)

    def embed(self, looked) -> np.ndarray:
        rows, grams = looked
        chars = np.zeros((len(rows), CHAR_SIZE), np.float32)
        for buckets, some, count in grams:
            if len(some):
                chars[some] += np.add.reduceat(self.p["char"][buckets], np.cumsum(count) - count, axis=0) / np.sqrt(count)[:, None].astype(np.float32)
        return np.hstack([self.p["word"][rows], chars])

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"}

    def _run(self, d: str, gates: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states by step; steps beyond the text leave the state as it is."""
        u, h = self.p[f"u{d}"], np.zeros((mask.shape[1], HIDDEN), np.float32)
        out, held = np.empty((*mask.shape, HIDDEN), np.float32), {}
        whole = mask.all(1)
        for t in range(SPAN) if d == "f" else range(SPAN - 1, -1, -1):
            g, s = gates[t], h @ u
            zr = _sigmoid(g[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(g[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if keep:
                held[t] = (h, z, r, n, s[:, 2 * HIDDEN :])
            h = new if whole[t] else np.where(mask[t, :, None], new, h)
            out[t] = h
        return out, held

    def logits(self, gates: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False):
        """``gates[d]`` has the input gates by step and window, and ``mask`` says where words are."""
        runs = {d: self._run(d, gates[d], mask, keep) for d in "fb"}
        hidden = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        tanh = np.tanh(hidden @ self.p["at"] + self.p["ab"])
        e = np.where(mask, tanh @ self.p["av"], np.float32(-1e30))
        weight = np.exp(e - e.max(0)) * mask
        weight /= np.maximum(weight.sum(0), np.float32(1e-30))
        pooled = np.einsum("tb,tbh->bh", weight, hidden)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (runs, hidden, tanh, weight, pooled)) if keep else logit

    def gradients(self, looked, ids: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of the windows ``ids`` (by step, window; rows of ``looked``) and its
        gradients."""
        p, count = self.p, len(target)
        x = self.embed(looked)
        per_word = self.gates(x)
        logit, (runs, hidden, tanh, weight, pooled) = self.logits({d: per_word[d][ids] for d in "fb"}, mask, True)
        loss = float(np.mean(np.logaddexp(0, -np.where(target > 0, logit, -logit))))
        dl = ((_sigmoid(logit) - target) / count).astype(np.float32)
        grad = {"out": pooled.T @ dl, "bias": np.array([dl.sum()])}
        dpool = dl[:, None] * p["out"]
        dweight = (hidden * dpool).sum(2)
        de = weight * (dweight - (weight * dweight).sum(0))
        grad["av"] = np.einsum("tba,tb->a", tanh, de)
        dtanh = de[:, :, None] * p["av"] * (1 - tanh**2)
        grad["at"], grad["ab"] = np.einsum("tbh,tba->ha", hidden, dtanh), dtanh.sum((0, 1))
        dhidden = weight[:, :, None] * dpool + dtanh @ p["at"].T
        dx = np.zeros_like(x)
        for d, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            u, held = p[f"u{d}"], runs[d][1]
            du, dgates, back = np.zeros_like(u), np.zeros((SPAN, count, 3 * HIDDEN), np.float32), np.zeros((count, HIDDEN), np.float32)
            for t in range(SPAN - 1, -1, -1) if d == "f" else range(SPAN):
                h, z, r, n, s = held[t]
                live = mask[t, :, None]
                dh = dhidden[t, :, half] + back
                dnew = np.where(live, dh, 0)
                dn = dnew * (1 - z) * (1 - n**2)
                dz, dr = dnew * (h - n) * z * (1 - z), dn * s * r * (1 - r)
                dgates[t] = np.hstack([dz, dr, dn])
                ds = np.hstack([dz, dr, dn * r])
                du += h.T @ ds
                back = np.where(live, dnew * z, dh) + ds @ u.T
            grad[f"u{d}"], grad[f"c{d}"] = du, dgates.sum((0, 1))
            dword = np.zeros((len(x), 3 * HIDDEN), np.float32)
            sum_rows(dgates[mask], dword, ids[mask])
            grad[f"w{d}"] = x.T @ dword
            dx += dword @ p[f"w{d}"].T
        rows, grams = looked
        grad["word"], grad["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        sum_rows(dx[:, :WORD_SIZE], grad["word"], rows)
        for buckets, some, n in grams:
            sum_rows(np.repeat(dx[some, WORD_SIZE:] / np.sqrt(n)[:, None], n, axis=0), grad["char"], buckets)
        return loss, grad


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.rate, self.step = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def update(self, grad: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in grad.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.step)) / (np.sqrt(self.v[k] / (1 - 0.99**self.step)) + 1e-6)


class WindowScorer:
    """Largest window logit of whole texts; the input gates of words seen before are kept, up to a
    bound."""

    def __init__(self, reader: Reader, cached: int = CACHED):
        self.reader, self.cached = reader, cached
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = {d: np.zeros((4096, 3 * HIDDEN), np.float32) for d in "fb"}

    def _number(self, texts: list[list[str]]) -> None:
        new = [w for w in set().union(*texts) if w not in self.at]
        if len(self.at) + len(new) > self.cached and self.at:
            self._clear()
            new = list(set().union(*texts))
        for lot in range(0, len(new), 20_000):
            words, base = new[lot : lot + 20_000], len(self.at)
            gates = self.reader.gates(self.reader.embed(self.reader.lookup(words)))
            for d in "fb":
                if base + len(words) > len(self.rows[d]):
                    grown = np.zeros((2 * (base + len(words)), 3 * HIDDEN), np.float32)
                    grown[:base] = self.rows[d][:base]
                    self.rows[d] = grown
                self.rows[d][base : base + len(words)] = gates[d]
            self.at.update(zip(words, range(base, base + len(words))))

    def window_logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Logits of the windows of each text that start at every ``STRIDE``-th word."""
        self._number(texts)
        get = self.at.__getitem__
        ids = [np.fromiter(map(get, t), np.int64, len(t)) for t in texts]
        spans = [windows_of(len(t)) for t in texts]
        which = np.concatenate([np.where(s >= 0, i[s] if len(i) else 0, -1) for s, i in zip(spans, ids)])
        out = np.empty(len(which), np.float32)
        short = which[:, -1] < 0  # the others need no mask
        for part in (np.flatnonzero(~short), np.flatnonzero(short)):
            for lot in range(0, len(part), 2048):
                at = np.ascontiguousarray(which[part[lot : lot + 2048]].T)
                mask, at = at >= 0, np.maximum(at, 0)
                out[part[lot : lot + 2048]] = self.reader.logits({d: self.rows[d][at] for d in "fb"}, mask)
        return np.split(out, np.cumsum([len(s) for s in spans])[:-1])


def seeds(texts: list[list[str]], toxic: np.ndarray, buckets: int = 2**18) -> list[np.ndarray]:
    """A first guess per word at how toxic it is: the largest log odds, over its character n-grams,
    of standing in a toxic text. Only used to choose the first training windows."""
    words = list(set().union(*texts)) if texts else []
    if not words:
        return [np.zeros(0) for _ in texts]
    grams = char_buckets(words, buckets)
    at = {w: i for i, w in enumerate(words)}
    texts_of = [np.unique([at[w] for w in t]).astype(np.int64) for t in texts]
    score = np.zeros(len(words))
    for found, some, count in grams:
        ends = np.zeros(len(words), np.int64)
        ends[some] = np.cumsum(count)
        begins = ends.copy()
        begins[some] -= count
        seen = np.zeros((2, buckets))
        for own, y in zip(texts_of, toxic):
            if len(own):
                seen[int(y), np.unique(np.concatenate([found[begins[i] : ends[i]] for i in own]))] += 1
        odds = np.log((seen[1] + 0.2) / (toxic.sum() + 1)) - np.log((seen[0] + 0.2) / ((1 - toxic).sum() + 1))
        odds[seen[1] < 2] = 0
        if len(some):
            score[some] = np.maximum(score[some], np.maximum.reduceat(odds[found], np.cumsum(count) - count))
    return [score[[at[w] for w in t]] if t else np.zeros(0) for t in texts]


def fold(text: str, folds: int) -> int:
    return crc32(text.encode()) % folds


def fit(texts: list[list[str]], toxic: np.ndarray, steps: int = 250, rounds: int = 2, batch: int = 192, seed: int = 11):
    """A reader, and weights that turn a text's largest window logit into the log odds of its label.

    Labels belong to texts, so windows are chosen: at first by ``seeds``, then by the reader itself.
    A toxic text gives its best windows, a clean text its worst and some others. A quarter of the
    texts only serves to calibrate.
    """
    rng = np.random.default_rng(seed)
    counts: dict[str, int] = {}
    for t in texts:
        for w in set(t):
            counts[w] = counts.get(w, 0) + 1
    often = sorted((w for w, n in counts.items() if n >= 3), key=lambda w: (-counts[w], w))[:20_000]
    reader = Reader({w: i for i, w in enumerate(often)})
    learn = np.array([fold(" ".join(t[:50]) + str(len(t)), 4) > 0 for t in texts], bool)
    if len(set(toxic[learn])) < 2:
        learn[:] = True
    guess = [(np.append(s, -1e9)[windows_of(len(t))]).max(1) for t, s in zip(texts, seeds(texts, toxic))]
    give_back()
    adam = Adam(reader.p)
    for r in range(rounds if len(set(toxic)) > 1 else 0):
        chosen, target = [], []
        for i in np.flatnonzero(learn):
            order = np.argsort(-guess[i], kind="stable")
            take = order[:2] if toxic[i] else np.unique(np.append(order[:2], rng.integers(0, len(order), 3)))
            if toxic[i]:
                take = take[guess[i][take] >= max(guess[i][order[0]] * 0.5, 0.0)] if r == 0 else take[:1]
            chosen += [(i, k) for k in take]
            target += [toxic[i]] * len(take)
        target = np.array(target, np.float32)
        groups = [np.flatnonzero(target == y) for y in (0, 1)]
        if not all(map(len, groups)):
            break
        for _ in range(steps):
            pick = np.concatenate([rng.choice(groups[0], batch - batch // 3), rng.choice(groups[1], batch // 3)])
            ids, words = np.full((SPAN, batch), -1), {}
            for b, k in enumerate(pick):
                i, w = chosen[k]
                for t, pos in enumerate(range(w * STRIDE, w * STRIDE + SPAN)):
                    if pos < len(texts[i]):
                        ids[t, b] = words.setdefault(texts[i][pos], len(words))
            if words:
                adam.update(reader.gradients(reader.lookup(list(words)), np.maximum(ids, 0), ids >= 0, target[pick])[1])
        scorer = WindowScorer(reader)
        guess = []
        for at in range(0, len(texts), 200):
            guess += scorer.window_logits(texts[at : at + 200])
        del scorer
        give_back()
    top = np.array([g.max() for g in guess])
    held = ~learn if len(set(toxic[~learn])) == 2 else np.ones(len(texts), bool)
    return reader, calibrate(top[held], toxic[held].astype(float))


def calibrate(top: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Intercept and slope of a logistic regression on the largest logit, held near 0 and 1."""
    x, middle, hold = np.column_stack([np.ones(len(top)), np.clip(top, -LIMIT, LIMIT)]), np.array([0.0, 1.0]), np.array([0.05, 2.0])

    def loss(w: np.ndarray) -> float:
        logit = x @ w
        return float(np.logaddexp(0, -np.where(toxic > 0, logit, -logit)).sum() + (hold * (w - middle) ** 2).sum() / 2)

    w = middle.copy()
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (toxic - p) - hold * (w - middle))
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
    return np.array([w[0], max(w[1], 0.05)])


def probability(weights: np.ndarray, logits: np.ndarray) -> float:
    return float(_sigmoid(weights @ np.array([1.0, np.clip(logits.max(), -LIMIT, LIMIT)])))
