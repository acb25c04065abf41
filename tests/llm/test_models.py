"""The vectorised scoring paths of the two classifiers against plain ones, step by step."""

import bisect
import math

import numpy as np
import pyarrow as pa

from cases import words
from playlens.llm import quality_gam as gam
from playlens.llm import toxicity as tox
from playlens.llm.textblocks import blocks


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_states(m, d, xs):
    h, out, size = np.zeros(tox.HIDDEN), [None] * len(xs), tox.HIDDEN
    for t in range(len(xs)) if d == "f" else range(len(xs) - 1, -1, -1):
        g, u = xs[t] @ m[d + "x"] + m[d + "c"], h @ m[d + "h"]
        z, r = sigmoid(g[:size] + u[:size]), sigmoid(g[size:2 * size] + u[size:2 * size])
        h = (1 - z) * h + z * np.tanh(g[2 * size:] + r * u[2 * size:])
        out[t] = h
    return out


def plain_logit(m, xs):
    """One window's logit: both directions, attention over the steps, one output unit."""
    states = [np.concatenate(s) for s in zip(plain_states(m, "f", xs), plain_states(m, "b", xs))]
    scores = [float(np.tanh(s @ m["attend"]) @ m["query"]) for s in states]
    weights = [math.exp(s - max(scores)) for s in scores]
    pooled = sum(w * s for w, s in zip(weights, states)) / sum(weights)
    return float(pooled @ m["out"] + m["bias"][0])


def test_toxicity_scores_equal_a_plain_network():
    rng = np.random.default_rng(4)
    model = {k: (v + rng.normal(scale=0.2, size=v.shape)).astype(np.float32) for k, v in tox.new_model(rng).items()}
    w = tox.WINDOW
    texts = ["one", words(1, w - 1), words(2, w), words(3, 3 * w + 5), "", None, "Mixed CASE \n words\t" * 4, words(4, w // 2 + 1)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    for block in blocks(batch):
        got = tox.score_texts(model, block, 0.25)
        inverse, word, grams, begin = tox.word_inputs(block)
        vectors = tox._vectors(model, word, grams, begin).astype(np.float64)
        m = {k: v.astype(np.float64) for k, v in model.items()}
        first = block.words()[2]
        for i in range(block.n):
            own = vectors[inverse[first[i]:first[i + 1]]]
            if not len(own):
                assert got[i] == 0.25
                continue
            # every half window, the last one moved back to be whole
            starts, s = [0], 0
            while s + w < len(own):
                s += tox.STRIDE
                starts.append(min(s, len(own) - w))
            logits = [plain_logit(m, own[s:s + w]) for s in starts]
            assert abs(got[i] - sigmoid(max(logits))) < 1e-4


def test_quality_prediction_is_a_plain_sum_of_table_entries():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 4)).round(1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(scale=0.3, size=900) > 0).astype(int)
    m = gam.train(x, y)
    got = gam.predict(m, x)
    for row, score in zip(x[:200], got):
        logit = m["intercept"]
        for cuts, table, value in zip(m["cuts"], m["tables"], row):
            logit += table[bisect.bisect_right(list(cuts), value)]
        for i, j, table in m["pairs"]:
            logit += table[bisect.bisect_right(list(m["pair_cuts"][i]), row[i])][bisect.bisect_right(list(m["pair_cuts"][j]), row[j])]
        assert abs(score - 1 / (1 + math.exp(-logit))) < 1e-12
    assert ((got >= 0.5) == y).mean() > 0.85 and m["pairs"]
