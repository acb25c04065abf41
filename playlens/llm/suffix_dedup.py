"""Exact substring duplicates through suffix order and longest-previous-factor arrays.

A position is a duplicate when the ``LENGTH``-byte string that starts there also
starts elsewhere in the corpus.  Texts are UTF-8 bytes, and strings never
cross documents.

1. Equal texts collapse to one representative.  A copied text of at least
   ``LENGTH`` bytes is a duplicate throughout.
2. Every ``LENGTH``-byte string names an anchor inside it: the least hash of its
   ``GRAM``-byte grams, leftmost first.  Equal strings name equal anchors at the
   same place, so only occurrences of anchors that the corpus holds more than
   once can matter.  Each occurrence owns the run of starts that named it, and
   the runs cut a text's starts into disjoint pieces.
3. Occurrences with the same anchor and the same bytes around form a class.
   One class per anchor is settled by its count alone.
4. The classes of an anchor are compared through suffix arrays: their starts in
   lexicographic order (of ``LENGTH`` bytes, ties by position), the common
   prefixes of neighbours, and the previous and next smaller positions in that
   order, which give the longest previous factor of each start and the earlier
   start it copies.  Starts at different distances from the anchor cannot agree
   and are ordered apart.  An anchor with more than :data:`HOT_CLASSES` classes
   is not gathered in a task: its starts are counted by the fingerprints of their
   strings, which Spark pre-aggregates.
5. The verdict of a class goes back to its occurrences and from there to texts.

Two results come out for every document: all copies of a duplicate removed
(``n_removed``), and later copies removed while the first one in the order
(doc_id, position) stays (``n_removed_later``).

Null and empty texts have no bytes and lose none.  Rows repeated under one id are
copies like any other.  If one id stands for several texts, or is null, the
copies' order goes by a hash of the text instead of the id.  An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bounded, written
from playlens.llm.textblocks import Block, fmix64

LENGTH, GRAM = 200, 80
SEGMENT = 1 << 20
HOT_CLASSES = 40_000
CLASSES_PER_BLOCK = 4_000
SUFFIXES_AT_ONCE = 50_000


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM):
    """(gram hash, context hash, first start, number of starts, anchor offset) of a text's runs, in order."""
    out = []
    for lo in range(0, max(len(raw) - length + 1, 0), SEGMENT):
        data = np.frombuffer(raw[lo:lo + SEGMENT + length - 1], np.uint8)
        n_starts = len(data) - length + 1
        block = Block(0, 1, data, np.array([0, len(data)]))
        at = np.arange(len(data) - gram + 1)
        grams = block.span_hashes(at, at + gram, lower=False)
        # the hash's upper bits with the place below them: minima are leftmost
        low = (grams & ~np.uint64((1 << 21) - 1)) | at.astype(np.uint64)
        width, reach = length - gram + 1, 1
        while reach * 2 <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < width:
            low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
        place = (low & np.uint64((1 << 21) - 1)).astype(np.int64)[:n_starts]
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        n = np.diff(np.concatenate([begin, [n_starts]]))
        offset = place[begin] - begin
        context = block.span_hashes(begin, begin + n + length - 1, lower=False)
        out.append((grams[place[begin]], fmix64(context + offset.astype(np.uint64)), begin + lo, n, offset))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out))


def _texts(batch, column):
    for i, value in enumerate(batch.column(column)):
        yield i, (value.as_py() or "").encode()


def _occurrences(length, gram):
    def run(batches):
        for batch in batches:
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            parts, held = [], 0
            for i, raw in _texts(batch, 1):
                g, c, lo, n, off = anchors(raw, length, gram)
                if len(g):
                    parts.append((g.view(np.int64), c.view(np.int64), np.full(len(g), reps[i]), lo << 16 | n << 8 | off))
                    held += len(g)
                if held > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)],
                                                     ["gram", "context", "rep", "run"])
                    parts, held = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)],
                                                 ["gram", "context", "rep", "run"])
    return run


def _context_batch(rows):
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                      ["gram", "context", "rep", "lo", "n", "off", "raw"])


def _contexts(length):
    """Bytes of the wanted runs of each text."""
    def run(batches):
        for batch in batches:
            wanted, reps = batch.column(2), batch.column(0)
            rows: list[tuple] = []
            for i, raw in _texts(batch, 1):
                rep = reps[i].as_py()
                for w in wanted[i].as_py():
                    lo, n, off = w["run"] >> 16, w["run"] >> 8 & 255, w["run"] & 255
                    rows.append((w["gram"], w["context"], rep, lo, n, off, raw[lo:lo + n + length - 1]))
                if len(rows) > 5_000:
                    yield _context_batch(rows)
                    rows = []
            if rows:
                yield _context_batch(rows)
    return run


def previous_factors(lcp: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous factor of each suffix, and the earlier suffix it copies.

    ``order`` lists text positions (as ranks) in suffix order, ``lcp[i]`` is the
    common prefix of suffixes i-1 and i of that order.  The best earlier match
    of a suffix is its previous or its next smaller position in suffix order;
    both come from one pass with a stack that carries the minimum of the common
    prefixes on the way.  Returned by place in suffix order (-1: none).
    """
    n = len(order)
    best, source = [0] * n, [-1] * n
    stack: list[tuple[int, int, int]] = []      # (place, position, common prefix with the one below)
    common, position = lcp.tolist(), order.tolist()
    for i in range(n):
        shared = common[i] if i else 0
        while stack and stack[-1][1] > position[i]:
            place, _, below = stack.pop()
            if shared > best[place]:            # i is the next smaller position of the popped suffix
                best[place], source[place] = shared, i
            shared = min(shared, below)
        if stack and shared > best[i]:          # the top is the previous smaller position
            best[i], source[i] = shared, stack[-1][0]
        stack.append((i, position[i], shared))
    return np.array(best, np.int64), np.array(source, np.int64)


def duplicate_starts(buffer: np.ndarray, at: np.ndarray, cell: np.ndarray, rank: np.ndarray, length: int):
    """(later, source) flags of starts ``at``; strings are compared within a ``cell`` only."""
    later, first = np.zeros(len(at), bool), np.zeros(len(at), bool)
    by_cell = np.lexsort((rank, cell))
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(cell[by_cell]) != 0, [True]]))
    whole = np.lib.stride_tricks.sliding_window_view(buffer, length)
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SUFFIXES_AT_ONCE, side="right")) - 1)
        own = by_cell[bounds[lo]:bounds[hi]]
        strings = whole[at[own]]
        # suffix order within cells, ties by position
        keys = np.ascontiguousarray(strings).view(f"S{length}").ravel()
        by_string = np.argsort(keys, kind="stable")
        by_string = by_string[np.argsort(cell[own][by_string], kind="stable")]
        own, strings = own[by_string], strings[by_string]
        differs = strings[1:] != strings[:-1]
        lcp = np.zeros(len(own), np.int64)
        lcp[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
        lcp[1:][cell[own][1:] != cell[own][:-1]] = 0
        near = (lcp >= length)
        near[:-1] |= lcp[1:] >= length
        kept = np.flatnonzero(near)             # a full match has a full match next to it
        if len(kept):
            inner = lcp[kept].copy()
            inner[1:][np.diff(kept) != 1] = 0
            factor, source = previous_factors(inner, rank[own[kept]])
            full = np.flatnonzero(factor >= length)
            later[own[kept[full]]] = True
            first[own[kept[source[full]]]] = True
        lo = hi
    return later, first


def _runs(flags: np.ndarray, owner: np.ndarray, step: np.ndarray):
    """(owner, from, to) of maximal flagged runs of consecutive steps of one owner."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on, on
    cut = np.concatenate([[True], (np.diff(on) != 1) | (owner[on][1:] != owner[on][:-1])])
    begin = on[cut]
    end = on[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(on) - 1]])]
    return owner[begin], step[begin], step[end]


_VERDICT = "gram long, context long, first long, later boolean, a int, b int"


def _compare(length):
    def run(key, table):
        gram, context = table.column("gram").to_numpy(), table.column("context").to_numpy()
        n, off = table.column("n").to_numpy().astype(np.int64), table.column("off").to_numpy().astype(np.int64)
        raw = table.column("raw").to_pylist()
        buffer = np.frombuffer(b"".join(raw), np.uint8)
        base = np.concatenate([[0], np.cumsum([len(r) for r in raw])])[:-1]
        place = np.lexsort((table.column("lo").to_numpy(), table.column("rep").to_numpy()))
        turn = np.empty(len(n), np.int64)
        turn[place] = np.arange(len(n))
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        groups = np.unique(gram, return_inverse=True)[1]
        cell = groups[owner] * (2 * length) + (off[owner] - step)
        rank = turn[owner] * (SEGMENT * 2) + step
        later, first = duplicate_starts(buffer, base[owner] + step, cell, rank, length)
        parts = []
        for flags, is_later in ((later | first, False), (later, True)):
            own, a, b = _runs(flags, owner, step)
            parts.append((gram[own], context[own], np.full(len(own), is_later), a.astype(np.int32), b.astype(np.int32)))
        g, c, l, a, b = (np.concatenate(x) for x in zip(*parts))
        return pa.table({"gram": g, "context": c, "first": pa.array(np.zeros(len(g), np.int64)), "later": l, "a": a, "b": b})
    return run


def _fingerprints(length):
    """One row per start of an anchor with very many classes."""
    def run(batches):
        for batch in batches:
            for i, raw in enumerate(batch.column("raw").to_pylist()):
                data = np.frombuffer(raw, np.uint8)
                n = len(data) - length + 1
                at = np.arange(n)
                prints = Block(0, 1, data, np.array([0, len(data)])).span_hashes(at, at + length, lower=False)
                same = {k: pa.array([batch.column(k)[i].as_py()] * n, pa.int64()) for k in ("gram", "context", "rep")}
                start = batch.column("lo")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [*same.values(), pa.array(prints.view(np.int64)), pa.array(at.astype(np.int32)),
                     pa.array(at + start)], ["gram", "context", "rep", "print", "a", "at"])
    return run


def _spread(spans: list, size: int, length: int) -> list[tuple[int, int]]:
    """Byte intervals covered by strings that start in the given ranges, merged."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, min(b, size)) for a, b in out]


def _cut(length):
    def run(batches):
        for batch in batches:
            ids, copies = batch.column("doc_id").to_pylist(), batch.column("copied").to_pylist()
            is_later, spans = batch.column("later_copy").to_pylist(), batch.column("spans")
            rows = []
            for i, raw in _texts(batch, 1):
                found = spans[i].as_py() or []
                results = []
                for whole, ranges in ((copies[i], [(s["a"], s["b"]) for s in found if not s["later"]]),
                                      (is_later[i], [(s["a"], s["b"]) for s in found if s["later"]])):
                    gone = [(0, len(raw))] if whole and len(raw) >= length else _spread(ranges, len(raw), length)
                    kept, last = hashlib.sha256(), 0
                    for a, b in gone:
                        kept.update(raw[last:a])
                        last = b
                    kept.update(raw[last:])
                    results += [sum(b - a for a, b in gone), len(gone), kept.hexdigest()]
                rows.append((ids[i], len(raw), *results))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                 "n_removed_later", "n_spans_later", "kept_later_sha256"])
    return run


def remove_duplicate_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                                hot_classes: int = HOT_CLASSES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the same for later copies only."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    key = F.md5(F.col("text").cast("binary"))
    keyed = written(rows.select("doc_id", key.alias("key")), "keys")
    by_key = written(keyed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "texts")
    # every row counts here, also one whose text is another row's
    several = keyed.groupBy("doc_id").agg(F.min("key").alias("k"), F.max("key").alias("l")).filter("k <> l or doc_id is null")
    odd = not written(several.select("doc_id"), "odd").isEmpty()
    if odd:     # ids that stand for several texts, or none: number the texts instead
        by_key = written(by_key.withColumn("rep", F.xxhash64("key")), "texts")
        texts = rows.withColumn("key", key).join(by_key, "key").select("key", "rep", "text").dropDuplicates(["key"]).drop("key")
    else:
        # one row per distinct text: its representative's
        own = keyed.join(by_key, "key").filter(F.col("doc_id") == F.col("rep"))
        # what is left without the later copies: few ids move, the texts do not
        again = written(own.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rep"), "again")
        gone = written(keyed.join(by_key.filter("copies > 1").select("key", "rep"), "key").filter("doc_id <> rep")
                       .select("doc_id").distinct(), "gone")
        texts = rows.join(bounded(gone), "doc_id", "left_anti").select(F.col("doc_id").alias("rep"), "text")
        texts = texts if again.isEmpty() else texts.dropDuplicates(["rep"])
    return _finish(rows, key, keyed, by_key, texts, odd, length, gram, hot_classes)


def _finish(rows, key, keyed, by_key, texts, odd, length, gram, hot_classes) -> DataFrame:
    occ = written(texts.mapInArrow(_occurrences(length, gram),
                                   "gram long, context long, rep long, run long"), "anchors")
    common = occ.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("gram")
    shared = written(occ.join(common, "gram", "left_semi"), "shared")
    classes = shared.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("rep", "run")).alias("o"))
    classes = written(classes.select("gram", "context", "copies", "o.*"), "classes")
    kinds = written(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "kinds")
    several = classes.join(kinds, "gram")
    wanted = written(several.groupBy("rep").agg(F.collect_list(F.struct("gram", "context", "run")).alias("wanted")), "wanted")
    able = texts.join(bounded(wanted.select("rep")), "rep", "left_semi")
    contexts = written(able.join(wanted, "rep").select("rep", "text", "wanted").mapInArrow(
        _contexts(length), "gram long, context long, rep long, lo long, n int, off int, raw binary"), "contexts")
    sized = contexts.join(kinds, "gram")
    n_blocks = max(1, -(-contexts.count() // CLASSES_PER_BLOCK))
    verdict = (sized.filter(F.col("kinds") <= hot_classes).drop("kinds")
               .withColumn("_b", F.pmod(F.xxhash64("gram"), F.lit(n_blocks)))
               .groupBy("_b").applyInArrow(_compare(length), _VERDICT)).drop("first")
    hot = sized.filter(F.col("kinds") > hot_classes)
    if not hot.isEmpty():
        prints = written(hot.mapInArrow(_fingerprints(length), "gram long, context long, rep long, print long, a int, at long"), "prints")
        twins = prints.groupBy("print").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rep", "at")).alias("f")).filter("c > 1")
        found = prints.join(twins, "print")
        single = found.select("gram", "context", F.lit(False).alias("later"), "a", F.col("a").alias("b")).unionByName(
            found.filter("f.rep <> rep or f.at <> at").select("gram", "context", F.lit(True).alias("later"), "a", F.col("a").alias("b")))
        verdict = verdict.unionByName(single)
    verdict = written(verdict.groupBy("gram", "context").agg(F.collect_list(F.struct("later", "a", "b")).alias("v")), "verdict")
    firsts = classes.select("gram", "context", "copies", F.struct("rep", F.shiftright("run", 16).alias("lo")).alias("f"))
    shared = shared.withColumn("lo", F.shiftright("run", 16)).withColumn(
        "n", F.shiftright("run", 8).bitwiseAND(F.lit(255)))
    judged = shared.join(firsts, ["gram", "context"]).join(verdict, ["gram", "context"], "left")
    whole = F.struct(F.lit(0).alias("a"), (F.col("n") - 1).cast("int").alias("b"))
    not_first = (F.col("f.rep") != F.col("rep")) | (F.col("f.lo") != F.col("lo"))

    def place(later: bool):
        own = F.transform(F.filter(F.coalesce("v", F.array().cast("array<struct<later:boolean,a:int,b:int>>")),
                                   lambda s: s["later"] == F.lit(later)), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))
        all_of_it = (F.col("copies") > 1) & not_first if later else F.col("copies") > 1
        return F.transform(F.when(all_of_it, F.array(whole)).otherwise(own), lambda s: F.struct(
            F.lit(later).alias("later"), (F.col("lo") + s["a"]).alias("a"), (F.col("lo") + s["b"]).alias("b")))

    spans = (judged.select("rep", F.explode(F.concat(place(False), place(True))).alias("s"))
             .groupBy("rep").agg(F.collect_list("s").alias("spans")))
    info = by_key.select("key", "rep", "copies").join(spans, "rep", "left")
    name = F.col("doc_id").eqNullSafe(F.col("rep")) if not odd else F.lit(False)
    mark = rows.withColumn("key", key) if odd else None
    if odd:
        first_ids = keyed.groupBy("key").agg(F.min("doc_id").alias("first_id"))
        joined = mark.join(info.join(first_ids, "key"), "key").withColumn(
            "later_copy", (F.col("copies") > 1) & ~F.col("doc_id").eqNullSafe(F.col("first_id")))
    else:
        per_doc = keyed.join(info, "key").filter("copies > 1 or spans is not null").withColumn("later_copy", ~name)
        per_doc = written(per_doc.select(F.col("doc_id").alias("_d"), "copies", "spans", "later_copy").dropDuplicates(["_d"]), "spans")
        ids = bounded(per_doc.select("_d"))
        found = rows.join(ids, rows["doc_id"] == ids["_d"], "left_semi")
        joined = found.join(per_doc, found["doc_id"] == per_doc["_d"]).drop("_d").unionByName(
            rows.join(ids, rows["doc_id"] == ids["_d"], "left_anti"), allowMissingColumns=True)
    return joined.select("doc_id", "text", (F.coalesce("copies", F.lit(1)) > 1).alias("copied"),
                         F.coalesce("later_copy", F.lit(False)).alias("later_copy"), "spans").mapInArrow(
        _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                      "n_removed_later long, n_spans_later long, kept_later_sha256 string")
