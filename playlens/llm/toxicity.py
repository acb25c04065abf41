"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Every word enters as its hashed word embedding beside the mean of its hashed
character n-gram embeddings (byte trigrams with word edges, and word prefixes).
Words are read in windows of :data:`WINDOW` words at half-window steps, so every
word lies in two windows and a text of any length is read whole.  A window's
states are pooled by attention into one logit; the text's score is the
probability of its strongest window.

Training sees labels of whole texts only: the text's logit is the
softmax-weighted mean of its windows' logits, so the gradient finds the windows
that matter.  It uses at most :data:`PER_CLASS` texts per class of at most
:data:`TRAIN_WORDS` words each (the documented sample bound), a fixed seed and
a fixed order, so reruns give the same weights.

A text without words (null, empty, blank) scores the training share of label 1,
at most 0.49.  With one class missing from the training rows every text scores
that share; without any (an empty ``labels``) the share is 0.  Every row comes
back, repeated ones too; an empty table gives no rows.  Only ``text`` enters the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.labelled import fold, training_rows
from playlens.llm.textblocks import Block, blocks

WINDOW, STRIDE = 24, 12
CHAR_BITS = 14
WORD_BUCKETS = CHAR_BUCKETS = 1 << CHAR_BITS
DIM, HIDDEN, ATTEND = 8, 8, 8
PER_CLASS, TRAIN_WORDS = 1500, 400
EPOCHS, BATCH_DOCS, RATE, LEAST_STEPS = 6, 32, 0.01, 300
MIN_SEEN = 3
#: Texts are scored in blocks of this many bytes: a word's vector is made once per block.
SCORE_BYTES = 1 << 21
PREFIXES = (4, 5, 6)
CHUNK = 1024


def word_inputs(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inverse, word bucket, n-gram buckets, n-gram begin): the distinct words of a block."""
    starts, ends, _ = block.words()
    hashes = block.word_hashes()
    distinct, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    s, e = starts[index], ends[index]
    size = e - s
    # byte trigrams: edges count as byte 0
    lowered = np.where((block.data >= 65) & (block.data <= 90), block.data + 32, block.data).astype(np.uint32)
    begin = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(begin[-1]) + np.repeat(s - begin[:-1], size)
    letters = lowered[at]
    left, right = np.concatenate([letters[:1], letters[:-1]]), np.concatenate([letters[1:], letters[:1]])
    left[begin[:-1]], right[begin[1:] - 1] = 0, 0
    grams = ((left << np.uint32(16) | letters << np.uint32(8) | right) * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)
    own = np.repeat(np.arange(len(distinct)), size)
    parts, owners = [grams.astype(np.int64)], [own]
    for k in PREFIXES:
        long_enough = np.flatnonzero(size >= k)
        parts.append((block.span_hashes(s[long_enough], s[long_enough] + k) >> np.uint64(64 - CHAR_BITS)).astype(np.int64))
        owners.append(long_enough)
    grams, own = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return (inverse, (distinct % np.uint64(WORD_BUCKETS)).astype(np.int64),
            grams[order], np.searchsorted(own[order], np.arange(len(distinct) + 1)))


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length) of every window; words of text i are first[i]..first[i+1]."""
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    # the last window of a text moves back to be a whole one
    start = np.maximum(np.minimum(first[text] + k * STRIDE, first[text + 1] - WINDOW), first[text])
    return text, start, np.minimum(WINDOW, first[text + 1] - start)


def new_model(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def draw(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)
    m = {"word": draw(WORD_BUCKETS, DIM, scale=0.1), "char": draw(CHAR_BUCKETS, DIM, scale=0.3),
         "attend": draw(2 * HIDDEN, ATTEND, scale=0.3), "query": draw(ATTEND, scale=0.5),
         "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for d in ("f", "b"):
        m[d + "x"] = draw(2 * DIM, 3 * HIDDEN, scale=0.4)
        m[d + "h"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        m[d + "c"] = np.zeros(3 * HIDDEN, np.float32)
    return m


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _vectors(m, word, grams, begin):
    chars = np.add.reduceat(m["char"][grams], begin[:-1], axis=0) if len(grams) else np.zeros((0, DIM), np.float32)
    return np.concatenate([m["word"][word], chars / np.maximum(np.diff(begin), 1)[:, None]], axis=1).astype(np.float32)


def _run(m, d, gates, mask, keep=False):
    """States (T, N, H) of one direction; ``gates`` are the input projections (T, N, 3H)."""
    steps, n, _ = gates.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out, cache = np.empty((steps, n, HIDDEN), np.float32), [None] * steps
    rec = m[d + "h"]
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        g, u = gates[t], h @ rec
        both = _sigmoid(g[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
        z, r = both[:, :HIDDEN], both[:, HIDDEN:]
        c = np.tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        new = h + z * (c - h)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep:
            cache[t] = h, z, r, c, u[:, 2 * HIDDEN:]
        out[t] = h = new
    return out, cache


def _pool(m, states, mask):
    hidden = np.tanh(states @ m["attend"])
    score = hidden @ m["query"]
    if mask is not None:
        score = np.where(mask, score, np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    return pooled @ m["out"] + m["bias"][0], hidden, weight, pooled


def _states(m, d, proj, at, mask):
    """States (T, N, H) of one direction; every array of a step is contiguous."""
    # sigmoid(x) = (1 + tanh(x / 2)) / 2: the half is in the weights already
    recs = [np.ascontiguousarray(m[d + "h"][:, k * HIDDEN:(k + 1) * HIDDEN] * np.float32(0.5 if k < 2 else 1)) for k in range(3)]
    n = at.shape[1]
    h, out = np.zeros((n, HIDDEN), np.float32), np.empty((WINDOW, n, HIDDEN), np.float32)
    z, r, c, g = (np.empty((n, HIDDEN), np.float32) for _ in range(4))
    half, one = np.float32(0.5), np.float32(1)
    for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
        for gate, rec, table in ((z, recs[0], proj[0]), (r, recs[1], proj[1])):
            np.matmul(h, rec, out=gate)
            gate += np.take(table, at[t], axis=0, out=g, mode="clip")
            np.tanh(gate, out=gate)
            gate += one
            gate *= half
        np.matmul(h, recs[2], out=c)
        c *= r
        c += np.take(proj[2], at[t], axis=0, out=g, mode="clip")
        np.tanh(c, out=c)
        c -= h
        c *= z
        if mask is not None:
            c *= mask[t][:, None]
        h = np.add(h, c, out=out[t])
    return out


def window_logits(m, vectors, inverse, start, length) -> np.ndarray:
    """Logits of all windows, a bounded number at a time; whole windows apart from short ones."""
    proj = {d: [np.ascontiguousarray((vectors @ m[d + "x"][:, s] + m[d + "c"][s]) * np.float32(f))
                for s, f in ((slice(0, HIDDEN), 0.5), (slice(HIDDEN, 2 * HIDDEN), 0.5), (slice(2 * HIDDEN, None), 1))]
            for d in ("f", "b")}
    out = np.empty(len(start), np.float32)
    steps = np.arange(WINDOW)[:, None]
    for rows in (np.flatnonzero(length == WINDOW), np.flatnonzero(length < WINDOW)):
        for lo in range(0, len(rows), CHUNK):
            own = rows[lo:lo + CHUNK]
            at = inverse[np.minimum(start[own] + steps, len(inverse) - 1)]
            mask = None if length[own[0]] == WINDOW else (steps < length[own]).astype(np.float32)
            fwd, bwd = _states(m, "f", proj["f"], at, mask), _states(m, "b", proj["b"], at, mask)
            hidden = np.matmul(fwd, m["attend"][:HIDDEN])
            hidden += np.matmul(bwd, m["attend"][HIDDEN:])
            np.tanh(hidden, out=hidden)
            weight = np.matmul(hidden, m["query"])
            if mask is not None:
                weight = np.where(mask > 0, weight, np.float32(-1e9))
            weight -= weight.max(axis=0)
            np.exp(weight, out=weight)
            value = np.matmul(fwd, m["out"][:HIDDEN]) + np.matmul(bwd, m["out"][HIDDEN:])
            out[own] = (weight * value).sum(axis=0) / weight.sum(axis=0) + m["bias"][0]
    return out


def _gradients(m, vectors, inverse, text, start, length, labels):
    """Loss gradient of a batch of texts with respect to the weights and the word vectors."""
    steps = np.arange(WINDOW)[:, None]
    mask = steps < length
    at = inverse[np.minimum(start + steps, len(inverse) - 1)]
    x = vectors[at]
    runs = {d: _run(m, d, x @ m[d + "x"] + m[d + "c"], mask, keep=True) for d in ("f", "b")}
    states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
    logit, hidden, weight, pooled = _pool(m, states, mask)
    n = len(labels)
    top = np.full(n, -np.inf, np.float32)
    np.maximum.at(top, text, logit)
    share = np.exp(logit - top[text])
    share /= np.bincount(text, share, n)[text]
    mean = np.bincount(text, share * logit, n)
    error = (_sigmoid(mean) - labels) / n
    d_logit = (error[text] * share * (1 + logit - mean[text])).astype(np.float32)
    g = {"bias": np.array([d_logit.sum()], np.float32), "out": d_logit @ pooled}
    d_pooled = d_logit[:, None] * m["out"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = (states * d_pooled).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["query"] = np.einsum("tn,tna->a", d_score, hidden)
    d_hidden = d_score[:, :, None] * m["query"] * (1 - hidden ** 2)
    g["attend"] = np.einsum("tnh,tna->ha", states, d_hidden)
    d_states = d_states + d_hidden @ m["attend"].T
    d_x = np.zeros_like(x)
    for k, d in enumerate(("f", "b")):
        rec, cache = m[d + "h"], runs[d][1]
        g_rec, carry = np.zeros_like(rec), np.zeros((len(logit), HIDDEN), np.float32)
        d_gates = np.empty((WINDOW, len(logit), 3 * HIDDEN), np.float32)
        for t in range(WINDOW - 1, -1, -1) if d == "f" else range(WINDOW):
            h, z, r, c, u = cache[t]
            total = d_states[t, :, k * HIDDEN:(k + 1) * HIDDEN] + carry
            live = np.where(mask[t][:, None], total, 0)
            d_c = live * z * (1 - c ** 2)
            d_z, d_r = live * (c - h) * z * (1 - z), d_c * u * r * (1 - r)
            d_gates[t] = np.concatenate([d_z, d_r, d_c], axis=1)
            d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
            g_rec += h.T @ d_u
            carry = live * (1 - z) + d_u @ rec.T + np.where(mask[t][:, None], 0, total)
        g[d + "h"], g[d + "c"] = g_rec, d_gates.sum(axis=(0, 1))
        g[d + "x"] = np.einsum("tnd,tng->dg", x, d_gates)
        d_x += d_gates @ m[d + "x"].T
    d_vectors = np.zeros((len(vectors), 2 * DIM), np.float32)
    for j in range(2 * DIM):
        d_vectors[:, j] = np.bincount(at.ravel(), d_x[:, :, j].ravel(), len(vectors))
    return g, d_vectors, float(np.mean(np.logaddexp(0, np.where(labels > 0, -mean, mean))))


def _rare(texts: list[str]) -> dict[str, np.ndarray]:
    """Word and n-gram buckets that fewer than :data:`MIN_SEEN` training texts use."""
    seen = {"word": np.zeros(WORD_BUCKETS, np.int64), "char": np.zeros(CHAR_BUCKETS, np.int64)}
    for text in texts:
        batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
        block = next(blocks(batch, limit=1 << 40))
        if block.words()[2][-1]:
            _, word, grams, _ = word_inputs(block)
            seen["word"][np.unique(word)] += 1
            seen["char"][np.unique(grams)] += 1
    return {k: v < MIN_SEEN for k, v in seen.items()}


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> dict[str, np.ndarray] | None:
    """Weights fitted to whole-text labels, or None without both classes."""
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    m = new_model(rng)
    m["bias"][0] = -1.0
    frozen: dict[str, np.ndarray] = {}
    first_moment = {k: np.zeros_like(v) for k, v in m.items()}
    second_moment = {k: np.zeros_like(v) for k, v in m.items()}
    for name, rare in _rare(texts).items():      # buckets hardly seen say nothing
        m[name][rare] = 0
        frozen[name] = rare
    groups = [np.flatnonzero(labels == y) for y in (0, 1)]
    per_class = max(len(g) for g in groups)
    step = 0
    batches = -(-2 * per_class // BATCH_DOCS)
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS // batches))):
        order = np.stack([np.resize(rng.permutation(g), per_class) for g in groups], axis=1).ravel()
        for lo in range(0, len(order), BATCH_DOCS):
            rows = order[lo:lo + BATCH_DOCS]
            batch = pa.RecordBatch.from_arrays([pa.array([texts[i] for i in rows], pa.string())], ["text"])
            block = next(blocks(batch, limit=1 << 40))
            first = block.words()[2]
            if first[-1] == 0:
                continue
            inverse, word, grams, begin = word_inputs(block)
            vectors = _vectors(m, word, grams, begin)
            text, start, length = windows_of(first)
            used, text = np.unique(text, return_inverse=True)
            g, d_vectors, _ = _gradients(m, vectors, inverse, text, start, length, labels[rows][used])
            share = d_vectors[:, DIM:] / np.maximum(np.diff(begin), 1)[:, None]
            spread = np.repeat(share, np.diff(begin), axis=0)
            g["word"] = np.stack([np.bincount(word, d_vectors[:, j], WORD_BUCKETS) for j in range(DIM)], axis=1)
            g["char"] = np.stack([np.bincount(grams, spread[:, j], CHAR_BUCKETS) for j in range(DIM)], axis=1)
            step += 1
            for k, v in m.items():
                grad = g[k].astype(np.float32)
                if k in frozen:
                    grad[frozen[k]] = 0
                first_moment[k] += 0.1 * (grad - first_moment[k])
                second_moment[k] += 0.001 * (grad ** 2 - second_moment[k])
                v -= (RATE * (first_moment[k] / (1 - 0.9 ** step))
                      / (np.sqrt(second_moment[k] / (1 - 0.999 ** step)) + 1e-6)).astype(np.float32)
    return m


def score_texts(m: dict[str, np.ndarray] | None, block: Block, base: float) -> np.ndarray:
    """Probability of each text's strongest window; ``base`` for texts without words."""
    out = np.full(block.n, base)
    first = block.words()[2]
    if m is None or first[-1] == 0:
        return out
    inverse, word, grams, begin = word_inputs(block)
    text, start, length = windows_of(first)
    logit = window_logits(m, _vectors(m, word, grams, begin), inverse, start, length)
    top = np.full(block.n, -np.inf)
    np.maximum.at(top, text, logit)
    some = np.isfinite(top)
    out[some] = _sigmoid(top[some])
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    """(weights, base score) from the bounded training sample."""
    rows = training_rows(docs, labels, "toxic", 5, 0, per_class, TRAIN_WORDS).toPandas()
    rows = rows.sort_values(["_h", "doc_id"])
    base = float(rows["label"].mean()) if len(rows) else 0.0
    return train(rows["text"].tolist(), rows["label"].to_numpy()), min(base, 0.49)


def _scorer(model, base):
    def run(batches):
        for batch in batches:
            for block in blocks(batch, limit=SCORE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(batch.column(0).slice(block.lo, block.n), pa.int64()), pa.array(score_texts(model, block, base))],
                    ["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, model, base: float) -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return rows.mapInArrow(_scorer(model, base), "doc_id long, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model, base = fit(docs, labels)
    return score_documents(docs, model, base).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _cleaner(model, base):
    def run(batches):
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for block in blocks(batch, column="text", limit=SCORE_BYTES):
                keep.append(score_texts(model, block, base) < 0.5)
            yield batch.filter(pa.array(np.concatenate(keep)))
    return run


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic: one map, no join."""
    model, base = fit(docs, labels)
    return docs.mapInArrow(_cleaner(model, base), docs.schema)
