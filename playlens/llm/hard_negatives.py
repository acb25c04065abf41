"""Hard negatives by exact search in a GNAT-style multiway hyperplane tree.

The score of two rows is the inner product of their integer vectors.  One more
coordinate ``sqrt(M**2 - |x|**2)`` (``M``: the largest norm; an anchor takes 0) makes it a
distance: ``d(q, x)**2 = |q|**2 + M**2 - 2 * score``, so a window of scores is an annulus
around the anchor.

1. Split points of the top node come from a bounded sample (:data:`SAMPLE` rows by
   smallest hash), chosen farthest first.  Every row of the table goes to its nearest
   split point; for every split point and every sibling subtree the node
   stores the range of distances from the point to the subtree's rows.
2. A subtree's rows are dealt to pages of about :data:`PAGE_ROWS` rows, so a very
   common vector spreads over many pages; a task that searches a page builds the tree's
   lower nodes over it in the same manner, down to leaves of :data:`LEAF` rows.
3. A search asks for the first ``k`` rows of a score window.  At each node the
   distances from the anchor to all split points are taken; a sibling is eliminated
   when, for any split point, its range cannot meet the anchor's annulus.
   While a page is searched, the ``k``-th best score narrows the annulus.
   Leaves are scored exactly, in whole numbers.
4. Positives: the anchor's own subtree first (it gives the bound), then every subtree
   that can hold a better row.  Negatives: one window per positive, every subtree
   that its annulus meets.  The first ``k`` of each page are merged by Spark.

Elimination only uses bounds with a margin for rounding, so results are exact (recall 1).
Anchors are dealt to groups of at most :data:`ANCHORS`, and a task holds one page
and one group.  The table is not collected: the driver holds the sample, the split
points and their ranges (:data:`MAX_SPLITS` squared numbers at most).

Nulls: a row without ``vec_id``, label or vector, or with a null or non-finite
component, takes no part.  Rows that repeat a ``vec_id`` count as one, that of the
smallest label and vector.  Vectors of several lengths: missing components
are zeros; an empty vector scores 0 with all.  Ties: smaller ``vec_id`` first.  An
anchor without another row of its label has no positives, and a positive with no row in its window gives
no rows; a negative positive score has an empty window.  Scores that leave 63 bits raise
an error.  An empty table gives no rows.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import written

SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, UNIT = 30, 90, 100       # LOW * positive <= UNIT * negative <= HIGH * positive
SAMPLE = 2048
SPLIT_ROWS = 2048                   # rows of a subtree of the top node aimed at
MAX_SPLITS = 256
PAGE_ROWS = 8192
ANCHORS = 2048
WAYS, LEAF = 12, 256                # split points of a lower node; rows of a leaf
MARGIN = 1e-6

LEAST = np.iinfo(np.int64).min


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to the rows of ``b``."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """The vectors with the coordinate that gives all of them the norm ``sqrt(top)``."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))])


def farthest_first(points: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` positions of distinct points, each farthest from those before."""
    chosen = [0]
    gap = _distances(points, points[:1])[:, 0]
    while len(chosen) < k:
        at = int(gap.argmax())
        if gap[at] <= MARGIN * (1 + np.abs(points).max()):
            break
        chosen.append(at)
        gap = np.minimum(gap, _distances(points, points[at:at + 1])[:, 0])
    return np.array(chosen)


def ranges(to_split: np.ndarray, owner: np.ndarray, ways: int) -> tuple[np.ndarray, np.ndarray]:
    """(low, high)[i, j]: the distances from split point i to the rows of subtree j; empty subtrees get an empty range."""
    low, high = np.full((ways, ways), np.inf), np.full((ways, ways), -np.inf)
    for j in range(ways):
        own = to_split[owner == j]
        if len(own):
            low[:, j], high[:, j] = own.min(0), own.max(0)
    return low, high


def meets(to_split: np.ndarray, low: np.ndarray, high: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """(queries, subtrees): whether the annulus from ``near`` to ``far`` around a query can hold a row of the subtree.

    A row whose distance to split point i is in [low, high] is at least
    ``max(d - high, low - d)`` and at most ``d + high`` from a query at distance d.
    """
    out = np.ones((len(to_split), low.shape[1]), dtype=bool)
    for i in range(low.shape[0]):
        d = to_split[:, i:i + 1]
        out &= (np.maximum(d - high[i], low[i] - d) <= far[:, None]) & (d + high[i] >= near[:, None])
    return out


def annulus(squared: np.ndarray, top: float, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(near, far): distances of scores ``most`` and ``least``, with a margin for rounding."""
    whole = squared + top
    slack = MARGIN * (1 + np.sqrt(whole))
    near = np.sqrt(np.maximum(whole - 2.0 * most, 0)) - slack
    far = np.sqrt(np.maximum(whole - 2.0 * least, 0)) + slack
    return near, far


class Search:
    """First ``k`` rows of each query's score window, over any number of pages.

    ``least`` and ``most`` bound the scores; ``same`` asks for rows of the query's label other
    than itself, else for rows of other labels.  ``ids`` and ``scores`` hold what was
    found, by descending score and ascending id; unfilled places have the least score.
    """

    def __init__(self, q: np.ndarray, qid: np.ndarray, label: np.ndarray, least: np.ndarray, most: np.ndarray, same: bool, k: int, top: float):
        self.q, self.qid, self.label, self.same, self.k, self.top = q, qid, label, same, k, top
        self.least, self.most = least.astype(np.int64), most.astype(np.int64)
        wide = q.astype(np.float64)
        self.squared = (wide * wide).sum(1)
        self.lift = np.column_stack([wide, np.zeros(len(q))])
        self.scores = np.full((len(q), k), LEAST, dtype=np.int64)
        self.ids = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)
        self.scored = 0

    def window(self, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The annuli of queries ``on``, narrowed by the k-th best found so far."""
        least = np.maximum(self.least[on], self.scores[on, -1]).astype(np.float64)
        return annulus(self.squared[on], self.top, np.maximum(least, -(self.squared[on] + self.top)), self.most[on].astype(np.float64))

    def leaf(self, on: np.ndarray, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        self.scored += len(on) * len(ids)
        score = inner(self.q[on], x)
        fits = (score >= self.least[on, None]) & (score <= self.most[on, None])
        fits &= (score >= self.scores[on, -1:])
        agree = labels[None, :] == self.label[on, None]
        fits &= agree & (ids[None, :] != self.qid[on, None]) if self.same else ~agree
        some = fits.any(axis=1)
        on, score, fits = on[some], score[some], fits[some]
        for lo in range(0, len(on), 256):       # bounded working memory
            part = slice(lo, lo + 256)
            rows = on[part]
            s = np.concatenate([self.scores[rows], np.where(fits[part], score[part], LEAST)], axis=1)
            i = np.concatenate([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
            i = np.where(s == LEAST, np.iinfo(np.int64).max, i)
            first = np.lexsort((i, ~s), axis=1)[:, :self.k]      # ~s: descending scores
            self.scores[rows] = np.take_along_axis(s, first, 1)
            self.ids[rows] = np.take_along_axis(i, first, 1)

    def tree(self, on: np.ndarray, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, points: np.ndarray | None = None) -> None:
        """Searches one node: rows ``x`` (their lifted ``points``) for queries ``on``."""
        if not len(on) or not len(x):
            return
        if points is None:
            points = lifted(x, self.top)
        split = farthest_first(points[:: max(1, len(points) // 512)], WAYS) if len(x) > LEAF else np.zeros(1)
        if len(split) < 2:      # a leaf, or rows that are all alike
            for lo in range(0, len(x), LEAF):
                part = slice(lo, lo + LEAF)
                self.leaf(on, x[part], ids[part], labels[part])
            return
        split = points[:: max(1, len(points) // 512)][split]
        to_split = _distances(points, split)
        owner = to_split.argmin(1)
        low, high = ranges(to_split, owner, len(split))
        mine = _distances(self.lift[on], split)
        nearest = np.argsort(mine.mean(0), kind="stable")
        for j in nearest:
            near, far = self.window(on)
            alive = meets(mine, low[:, j:j + 1], high[:, j:j + 1], near, far)[:, 0] & (self.least[on] <= self.most[on])
            rows = owner == j
            if alive.any() and rows.any():
                self.tree(on[alive], x[rows], ids[rows], labels[rows], points[rows])


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers."""
    width = max(a.shape[1], b.shape[1], 1)
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * width
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    raise ArithmeticError("scores leave 63 bits")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Packed int64 vectors as rows, padded with zeros to ``width``."""
    out = np.zeros((len(column), width), dtype=np.int64)
    raw = [v or b"" for v in column.to_pylist()]
    if raw and all(len(v) == 8 * width for v in raw):
        return np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), width)
    for i, v in enumerate(raw):
        row = np.frombuffer(v, np.int64)
        out[i, :len(row)] = row
    return out


def _pack(batches):
    """Packs the whole-number components of each vector into bytes, with their squared length."""
    for batch in batches:
        vectors = batch.column(2)
        offsets = np.asarray(vectors.offsets)
        values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
        whole = np.floor(SCALE * values)
        if len(whole) and np.abs(whole).max() >= 1 << 31:
            raise ArithmeticError("scores leave 63 bits")
        whole = whole.astype(np.int64)
        square = np.concatenate([np.zeros(1), np.cumsum((whole * whole).astype(np.float64))])
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1),
            pa.array([whole[lo:hi].tobytes() for lo, hi in zip(offsets[:-1], offsets[1:])], pa.binary()),
            pa.array(square[offsets[1:]] - square[offsets[:-1]]), pa.array(np.diff(offsets).astype(np.int32))],
            ["vec_id", "label", "vector", "square", "width"])


def _assign(split: np.ndarray, top: float, width: int):
    """Rows with their subtree, dealt to pages later."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = lifted(_matrix(batch.column(2), width), top)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(_distances(x, split).argmin(1).astype(np.int32))],
                    ["vec_id", "label", "vector", "subtree"])
    return run


def _ranges_of(split: np.ndarray, top: float, width: int):
    """(subtree, split, low, high) of each task's rows."""
    def run(batches):
        ways = len(split)
        low, high = np.full((ways, ways), np.inf), np.full((ways, ways), -np.inf)
        for batch in batches:
            if batch.num_rows:
                own = _distances(lifted(_matrix(batch.column(0), width), top), split)
                lo, hi = ranges(own, batch.column(1).to_numpy(), ways)
                low, high = np.minimum(low, lo), np.maximum(high, hi)
        i, j = np.nonzero(np.isfinite(low))
        yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(low[i, j]), pa.array(high[i, j])],
                                         ["subtree", "split", "low", "high"])
    return run


def _route(split: np.ndarray, low: np.ndarray, high: np.ndarray, top: float, width: int, own_only: bool):
    """Each query with the list of subtrees that can hold rows of its window."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("vector"), width).astype(np.float64)
            if own_only:        # the subtree of the anchor as a row of the table
                out = [[int(j)] for j in _distances(lifted(q, top), split).argmin(1)]
            else:
                squared = (q * q).sum(1)
                least, most = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("least", "most"))
                near, far = annulus(squared, top, np.maximum(least, -(squared + top)), most)
                on = meets(_distances(np.column_stack([q, np.zeros(len(q))]), split), low, high, near, far) & (least <= most)[:, None]
                out = [np.flatnonzero(r).tolist() for r in on]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, "subtrees"])
    return run


def _search_page(same: bool, k: int, top: float, width: int):
    def run(key, queries, rows):
        if queries.num_rows and rows.num_rows:
            ids = rows.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            x = _matrix(rows.column("vector").combine_chunks(), width)[order]
            find = Search(_matrix(queries.column("vector").combine_chunks(), width), queries.column("anchor_id").to_numpy(),
                          queries.column("label").to_numpy(), queries.column("least").to_numpy(), queries.column("most").to_numpy(), same, k, top)
            find.tree(np.arange(queries.num_rows), x, ids[order], rows.column("label").to_numpy()[order])
            row, place = np.nonzero(find.scores != LEAST)
            return pa.table({"anchor_id": queries.column("anchor_id").to_numpy()[row], "part": queries.column("part").to_numpy()[row],
                             "found_id": find.ids[row, place], "score": find.scores[row, place]})
        return pa.table({c: pa.array([], pa.int64()) for c in ("anchor_id", "part", "found_id", "score")})
    return run


class Index:
    """The top node (split points and ranges) and the table of all rows by subtree and page."""

    def __init__(self, rows: DataFrame):
        """``rows``: a written table (vec_id, label, vector, square, width)."""
        stats = rows.agg(F.max("square"), F.max("width"), F.count(F.lit(1))).first()
        self.n = stats[2]
        self.top, self.width = float(stats[0] or 0), int(stats[1] or 0)
        self.rows = None
        if not self.n:
            return
        sample = rows.select("vector", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(SAMPLE).collect()
        points = lifted(_matrix(pa.array([bytes(r["vector"]) for r in sample], pa.binary()), self.width), self.top)
        self.split = points[farthest_first(points, min(MAX_SPLITS, max(2, -(-self.n // SPLIT_ROWS))))]
        placed = written(rows.select("vec_id", "label", "vector").mapInArrow(
            _assign(self.split, self.top, self.width), "vec_id long, label long, vector binary, subtree int"), "placed")
        sizes = F.broadcast(placed.groupBy("subtree").agg(F.ceil(F.count(F.lit(1)) / PAGE_ROWS).cast("int").alias("pages")))     # one row a subtree
        self.rows = placed.join(sizes, "subtree").withColumn("page", F.pmod(F.xxhash64("vec_id"), F.col("pages")).cast("int")).drop("pages")
        self.pages = sizes
        found = (placed.select("vector", "subtree").mapInArrow(_ranges_of(self.split, self.top, self.width), "subtree int, split int, low double, high double")
                 .groupBy("subtree", "split").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
        ways = len(self.split)
        self.low, self.high = np.full((ways, ways), np.inf), np.full((ways, ways), -np.inf)
        for r in found:
            self.low[r["split"], r["subtree"]], self.high[r["split"], r["subtree"]] = r["low"], r["high"]

    def search(self, queries: DataFrame, same: bool, k: int, own_only: bool = False) -> DataFrame:
        """(anchor_id, part, found_id, score, place): the first ``k`` rows of each query's window.

        ``queries``: anchor_id, part, label, vector, least, most.
        """
        schema = "anchor_id long, part long, label long, vector binary, least long, most long"
        queries = queries.select("anchor_id", "part", "label", "vector", "least", "most")
        routed = queries.mapInArrow(_route(self.split, self.low, self.high, self.top, self.width, own_only), schema + ", subtrees array<int>")
        routed = (routed.withColumn("subtree", F.explode("subtrees")).drop("subtrees").join(self.pages, "subtree")
                  .withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1))).drop("pages"))
        routed = written(routed, "routed")
        # a page's queries are dealt to groups of bounded size, and the page goes to each group
        groups = routed.groupBy("subtree", "page").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("groups"))
        routed = routed.join(groups, ["subtree", "page"]).withColumn("g", F.pmod(F.xxhash64("anchor_id", "part"), F.col("groups")).cast("int")).drop("groups")
        rows = self.rows.join(groups, ["subtree", "page"]).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
        by = ["subtree", "page", "g"]
        found = routed.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(
            _search_page(same, k, self.top, self.width), "anchor_id long, part long, found_id long, score long")
        order = Window.partitionBy("anchor_id", "part").orderBy(F.col("score").desc(), "found_id")
        return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def prepared(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector, square, width) of the rows that take part, one per ``vec_id``."""
    v = embeddings["embedding"].cast("array<double>")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["label"].cast("long").alias("label"), v.alias("v"))
    rows = rows.filter("vec_id is not null and label is not null and v is not null").filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))
    packed = rows.select("vec_id", label.alias("label"), "v").mapInArrow(
        _pack, "vec_id long, label long, vector binary, square double, width int")
    one = F.min(F.struct("label", "vector", "square", "width")).alias("r")
    return packed.groupBy("vec_id").agg(one).select("vec_id", "r.*")


def mine_hard_negatives(embeddings: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                        low: int = LOW, high: int = HIGH, unit: int = UNIT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors: ids divisible by ``every``.  Positives: an anchor's first rows of its label.  For each, the first
    rows of other labels whose score s holds ``low * p <= unit * s <= high * p``.
    """
    spark = embeddings.sparkSession
    rows = written(prepared(embeddings), "vectors")
    index = Index(rows)
    if not index.n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    anchors = rows.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("anchor_id"), "label", "vector", F.lit(0).cast("long").alias("part"),
        F.lit(int(LEAST) + 1).cast("long").alias("least"), F.lit(int(np.iinfo(np.int64).max)).cast("long").alias("most"))
    seeds = index.search(anchors, True, positives, own_only=True)
    bound = written(seeds.filter(F.col("place") == positives).select("anchor_id", F.col("score").alias("bound")), "bounds")
    asked = anchors.join(bound, "anchor_id", "left").withColumn("least", F.coalesce("bound", "least"))
    best = written(index.search(asked, True, positives).select(
        "anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    asked = (anchors.drop("part", "least", "most").join(best, "anchor_id")
             .select("anchor_id", F.col("positive_id").alias("part"), "label", "vector",
                     F.ceil(F.col("positive_score") * low / F.lit(unit).cast("decimal(10,0)")).cast("long").alias("least"),
                     F.floor(F.col("positive_score") * high / F.lit(unit).cast("decimal(10,0)")).cast("long").alias("most"))
             .filter("least <= most"))
    found = index.search(asked, False, negatives).withColumnRenamed("part", "positive_id")
    return found.join(best, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = f"""
WITH rows AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
  list_transform(embedding, x -> floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
  list_inner_product(a.v, b.v)::BIGINT AS score FROM rows a JOIN rows b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id),
best AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM best JOIN scores USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= {UNIT} * score AND {UNIT} * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""
