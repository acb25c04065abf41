"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes :data:`FEATURES`, plain ratios counted over its whole text.
Features are cut into at most :data:`BINS` quantile bins.  Training boosts
cyclically: round after round, every feature in turn gets one shallow tree (at
most four leaves) on the gradients of its bins, and the tree's values are added
to that feature's lookup table.  Then the pairs of features whose best two-way
cut explains most of what is left are boosted the same way on coarse grids.  A
text's score is the logistic of the intercept plus one table entry per feature
and per pair, added up for all texts of a block at once.

Training uses at most :data:`PER_CLASS` labelled texts per class (the documented
sample bound), taken by id hash, so reruns give the same tables.  With one
class missing from them the score is that share everywhere.

Null and empty texts have all ratios 0 and are scored like any other; very long
ones are read whole.  Every row comes back, repeated ones too; an empty table
gives no rows.  Only ``text`` enters the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.labelled import fold, training_rows
from playlens.llm.textblocks import Block, blocks

FEATURES = ("log_words", "bytes_per_word", "symbol_share", "repeat_share", "new_word_share", "upper_share",
            "digit_share", "stop_share", "bang_share", "pipe_share", "line_words", "same_line_share",
            "short_share", "twin_share")
PER_CLASS = 6000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.1
LEAST_HESSIAN, RIDGE = 2.0, 1.0
THRESHOLD = 0.7


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER = _table(bytes(range(65, 91)))
_LETTER = _UPPER | _table(bytes(range(97, 123))) | _table(bytes(range(128, 256)))
_DIGIT, _STOP = _table(b"0123456789"), _table(b".,;:?")
_SYMBOL, _LINE = _table(b"#*$%&<>{}[]~^_=+@\\"), _table(b"\n")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def features(block: Block) -> np.ndarray:
    """One row of :data:`FEATURES` per text."""
    data, offsets = block.data, block.offsets
    starts, ends, first = block.words()
    words = np.diff(first).astype(np.float64)
    per_word, per_byte = 1 / np.maximum(words, 1), 1 / np.maximum(np.diff(offsets), 1)
    hashes, owner = block.word_hashes(), block.owners(first)
    distinct = np.diff(block.distinct(hashes, first)[1])
    windows, begin = block.shingles(3, False)
    fresh = np.diff(block.distinct(windows, begin)[1])
    n_windows = np.maximum(np.diff(begin), 1)
    letters = _sums(_LETTER[data], offsets)
    lines = _sums(_LINE[data], offsets) + 1
    twin = np.zeros(len(hashes), dtype=bool)
    twin[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    line_at = np.flatnonzero(_LINE[data])
    edges = np.unique(np.concatenate([offsets, line_at + 1]))
    edges = edges[edges <= len(data)]
    spans = edges[:-1], edges[1:] - 1
    whole = np.flatnonzero(spans[1] > spans[0])
    line_hash = block.span_hashes(spans[0][whole], spans[1][whole]) if len(whole) else np.zeros(0, np.uint64)
    line_first = np.searchsorted(spans[0][whole], offsets)
    new_lines = np.diff(block.distinct(line_hash, line_first)[1])
    return np.stack([
        np.log1p(words), np.diff(offsets) * per_word, _sums(_SYMBOL[data], offsets) * per_byte,
        (np.diff(begin) - fresh) / n_windows, distinct * per_word, _sums(_UPPER[data], offsets) / np.maximum(letters, 1),
        _sums(_DIGIT[data], offsets) * per_byte, _sums(_STOP[data], offsets) * per_word,
        _sums(data == 33, offsets) * per_word, _sums(data == 124, offsets) * per_word, words / lines,
        (np.diff(line_first) - new_lines) / np.maximum(np.diff(line_first), 1),
        _sums(ends - starts <= 3, first) * per_word, _sums(twin, first) * per_word], axis=1)


def _shallow(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Leaf value of each bin for the best tree of at most two levels of cuts."""
    def cut(lo, hi):
        g, h = np.cumsum(grad[lo:hi]), np.cumsum(hess[lo:hi])
        if hi - lo < 2:
            return None
        left_g, left_h, all_g, all_h = g[:-1], h[:-1], g[-1], h[-1]
        gain = (left_g ** 2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE)
                - all_g ** 2 / (all_h + RIDGE))
        gain[(left_h < LEAST_HESSIAN) | (all_h - left_h < LEAST_HESSIAN)] = 0
        at = int(np.argmax(gain))
        return lo + at + 1 if gain[at] > 1e-9 else None
    edges = [0, len(grad)]
    for _ in range(2):
        edges = sorted(edges + [c for c in (cut(a, b) for a, b in zip(edges, edges[1:])) if c is not None])
    out = np.zeros(len(grad))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + RIDGE)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Best four-leaf tree on a grid (a cut of one axis, then of the other on each side) and its gain."""
    best, out = 0.0, np.zeros_like(grad)
    base = grad.sum() ** 2 / (hess.sum() + RIDGE)
    for flip in (False, True):
        g, h = (grad.T, hess.T) if flip else (grad, hess)
        for at in range(1, g.shape[0]):
            tree, gain = np.zeros_like(g), -base
            for part in (slice(0, at), slice(at, None)):
                pg, ph = np.cumsum(g[part].sum(axis=0)), np.cumsum(h[part].sum(axis=0))
                value = (pg[:-1] ** 2 / (ph[:-1] + RIDGE) + (pg[-1] - pg[:-1]) ** 2 / (ph[-1] - ph[:-1] + RIDGE))
                k = int(np.argmax(value)) + 1
                gain += value[k - 1]
                tree[part, :k] = pg[k - 1] / (ph[k - 1] + RIDGE)
                tree[part, k:] = (pg[-1] - pg[k - 1]) / (ph[-1] - ph[k - 1] + RIDGE)
            if gain > best:
                best, out = gain, tree.T if flip else tree
    return out, best


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def train(x: np.ndarray, labels: np.ndarray) -> dict | None:
    """Tables fitted to the rows, or None without both classes."""
    y = np.asarray(labels, np.float64)
    if len(set(y.tolist())) < 2:
        return None
    m = {"intercept": float(np.log(y.mean() / (1 - y.mean()))),
         "cuts": [_cuts(c, BINS) for c in x.T], "pair_cuts": [_cuts(c, PAIR_BINS) for c in x.T]}
    fine = [np.searchsorted(cuts, c, side="right") for cuts, c in zip(m["cuts"], x.T)]
    coarse = [np.searchsorted(cuts, c, side="right") for cuts, c in zip(m["pair_cuts"], x.T)]
    m["tables"] = [np.zeros(len(c) + 1) for c in m["cuts"]]
    logit = np.full(len(y), m["intercept"])

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for bins, table in zip(fine, m["tables"]):
            grad, hess = slopes()
            step = RATE * _shallow(np.bincount(bins, grad, len(table)), np.bincount(bins, hess, len(table)))
            table += step
            logit += step[bins]

    def grid(i, j):
        shape = len(m["pair_cuts"][i]) + 1, len(m["pair_cuts"][j]) + 1
        return coarse[i] * shape[1] + coarse[j], shape

    def on_grid(i, j):
        cell, shape = grid(i, j)
        grad, hess = slopes()
        return cell, _pair_tree(np.bincount(cell, grad, shape[0] * shape[1]).reshape(shape),
                                np.bincount(cell, hess, shape[0] * shape[1]).reshape(shape))

    able = [i for i in range(x.shape[1]) if len(m["pair_cuts"][i])]
    ranked = sorted(((on_grid(i, j)[1][1], i, j) for i in able for j in able if i < j), reverse=True)[:PAIRS]
    m["pairs"] = [(i, j, np.zeros(grid(i, j)[1])) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in m["pairs"]:
            cell, (tree, _) = on_grid(i, j)
            table += RATE * tree
            logit += RATE * tree.ravel()[cell]
    return m


def predict(m: dict, x: np.ndarray) -> np.ndarray:
    logit = np.full(len(x), m["intercept"])
    for cuts, table, column in zip(m["cuts"], m["tables"], x.T):
        logit += table[np.searchsorted(cuts, column, side="right")]
    for i, j, table in m["pairs"]:
        logit += table[np.searchsorted(m["pair_cuts"][i], x[:, i], side="right"),
                       np.searchsorted(m["pair_cuts"][j], x[:, j], side="right")]
    return 1 / (1 + np.exp(-logit))


def _featurise(batches):
    for batch in batches:
        for block in blocks(batch):
            values = features(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.lo, block.n), batch.column(1).slice(block.lo, block.n),
                 batch.column(3).slice(block.lo, block.n), pa.array(list(values), pa.list_(pa.float64()))],
                ["doc_id", "label", "_h", "x"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    """(tables, base score) from the bounded training sample; only its numbers reach the driver."""
    rows = training_rows(docs, labels, "quality", 4, 2, per_class)
    rows = rows.mapInArrow(_featurise, "doc_id long, label int, _h long, x array<double>").toPandas()
    rows = rows.sort_values(["_h", "doc_id"])
    if not len(rows):
        return None, 0.0
    y = rows["label"].to_numpy()
    return train(np.array(rows["x"].tolist()), y), float(y.mean())


def _scorer(model, base):
    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                score = np.full(block.n, base) if model is None else predict(model, features(block))
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(batch.column(0).slice(block.lo, block.n), pa.int64()), pa.array(score)], ["doc_id", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model, base = fit(docs, labels)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return rows.mapInArrow(_scorer(model, base), "doc_id long, score double").select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
