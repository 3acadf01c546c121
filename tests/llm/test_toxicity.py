import numpy as np
import pytest

from riskweave.llm import reader
from riskweave.llm.lm import in_fold
from riskweave.llm.reader import SPAN, Reader, WindowScorer, fit, probability, windows_of
from riskweave.llm.toxicity import learn, toxicity_scores

STEMS = ["lowei", "vequ", "idiot"]


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    clean = [a + b for a in ("the", "on", "re", "ti", "sha") for b in ("nd", "ing", "ble", "er", "ou", "st")]
    texts, toxic = [], []
    for _ in range(n):
        words = rng.choice(clean, rng.integers(1, 120)).tolist()
        toxic.append(int(rng.random() < 0.3))
        for _ in range(toxic[-1] * int(rng.integers(1, 4))):
            stem = STEMS[rng.integers(3)]
            words.insert(int(rng.integers(0, len(words) + 1)), stem + ("" if stem == "idiot" else rng.choice(clean)))
        texts.append(words)
    return texts, np.array(toxic)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    reader = Reader({"one": 0, "two": 1}, seed=1)
    reader.p = {k: v.astype(np.float64) for k, v in reader.p.items()}
    words = ["one", "two", "a", "longerword", "x"]
    ids, mask = rng.integers(0, 5, (SPAN, 6)), np.ones((SPAN, 6), bool)
    mask[5:, 2] = mask[1:, 4] = False
    target = np.array([0, 1, 1, 0, 1, 0.0])
    looked = reader.lookup(words)
    _, grad = reader.gradients(looked, ids, mask, target)
    for name, value in reader.p.items():
        flat, want = value.reshape(-1), grad[name].reshape(-1)
        for at in np.unique(np.append(np.argsort(-np.abs(want))[:2], rng.integers(0, len(flat), 2))):
            keep = flat[at]
            flat[at] = keep + 1e-3
            up = reader.gradients(looked, ids, mask, target)[0]
            flat[at] = keep - 1e-3
            down = reader.gradients(looked, ids, mask, target)[0]
            flat[at] = keep
            assert want[at] == pytest.approx((up - down) / 2e-3, abs=2e-5), name


def test_windows_cover_every_word():
    for n in (0, 1, 11, 12, 13, 20, 21, 100):
        at = windows_of(n)
        assert set(at.ravel()) - {-1} == set(range(n)) and at.shape[1] == SPAN


def test_held_out_accuracy_and_cache():
    texts, toxic = corpus(600, 1)
    reader, weights = fit(texts, toxic, steps=150)
    other, truth = corpus(300, 2)
    scores = [probability(weights, w) for w in WindowScorer(reader).window_logits(other)]
    assert np.mean((np.array(scores) >= 0.5) == truth) > 0.95
    small = WindowScorer(reader, cached=5)
    again = [probability(weights, small.window_logits([t])[0]) for t in other[:40]]
    assert again == pytest.approx(scores[:40], abs=1e-4)
    assert np.array_equal(fit(texts[:50], toxic[:50], steps=20)[1], fit(texts[:50], toxic[:50], steps=20)[1])


def test_query_columns_and_odd_rows(spark):
    texts, toxic = corpus(300, 3)
    rows = [(i, " ".join(t), 1.0) for i, t in enumerate(texts)] + [(900, None, 1.0), (901, "", 1.0), (None, "idiot", 1.0), (3, "again", 1.0), (902, "w" * 50_000 + " x\n" * 30_000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(toxic)] + [(None, 1), (5, None), (7, int(toxic[7])), (5000, 1)], "doc_id long, toxic int")
    model = learn(docs, labels.filter(~in_fold("doc_id", 5, 0)))
    got = toxicity_scores(docs, model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity_scores(docs.limit(0), model).count() == 0
    untaught = learn(docs, labels.limit(0))
    assert toxicity_scores(docs, untaught).count() == len(rows)


def test_text_score_equals_a_plain_loop_over_windows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    model = reader.Reader({w: i for i, w in enumerate(words[:30])})
    p = model.p
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(xs, d):
        h, out, n = np.zeros(reader.HIDDEN), [], reader.HIDDEN
        for x in xs:
            g, s = x @ p[f"w{d}"] + p[f"c{d}"], h @ p[f"u{d}"]
            z, r = sigmoid(g[:n] + s[:n]), sigmoid(g[n : 2 * n] + s[n : 2 * n])
            new = np.tanh(g[2 * n :] + r * s[2 * n :])
            h = (1 - z) * new + z * h
            out.append(h)
        return out

    def logit(window):
        if not window:
            return float(p["bias"][0])
        xs = [model.embed(model.lookup([w]))[0].astype(float) for w in window]
        hidden = np.hstack([states(xs, "f"), states(xs[::-1], "b")[::-1]])
        e = np.tanh(hidden @ p["at"] + p["ab"]) @ p["av"]
        weight = np.exp(e - e.max())
        return float((weight / weight.sum()) @ hidden @ p["out"] + p["bias"][0])

    texts = [[], *[list(rng.choice(words, n)) for n in (1, 5, 11, 12, 13, 16, 17, 40, 200)]]
    for text, found in zip(texts, reader.WindowScorer(model).window_logits(texts)):
        starts, ends = range(0, max(1, len(text)), reader.STRIDE), len(text)
        windows = [text[a : a + reader.SPAN] for a in starts if a == 0 or a + reader.SPAN - reader.STRIDE < ends]
        assert np.allclose(found, [logit(w) for w in windows], atol=1e-4)
