"""SimHash near-duplicates by bit-sliced comparison.

1. One numpy pass per block of texts: A-Z lower-cased, words joined by single
   spaces, the XXH64 (seed 42) of every 4-word shingle, and a fingerprint whose
   bits are set in over half of the hashes.
2. Equal fingerprints collapse to one representative, its smallest document.
3. Fingerprints within ``radius`` bits of each other agree on at least
   ``blocks - radius`` of ``blocks`` blocks of bits.  Every choice of that many blocks
   is a table, and a table deals the fingerprints out by a key from the chosen
   blocks.  The number of blocks and the length of the keys follow from the number of
   fingerprints, so that a key holds about :data:`KEY_ROWS` of them; the result
   is exact at every setting.
4. The members of a key are cut into blocks of at most :data:`CELL_ROWS`, and a
   cell compares two of them, so a very common key is spread over many tasks.  In a
   cell the members stand bit-sliced: plane ``j`` holds bit ``j`` of 64
   members in each machine word.  The distances of a fingerprint to all members
   are counted at once, plane by plane, in carry-save counters (three words of
   ones, twos and fours and one that notes the overflow), and words whose
   64 members are all beyond the radius are abandoned on the way.
5. A cell returns links that join what it found (at most one link a member),
   and connected components of all links name the groups.

Tables hold 5 to 70 copies of a 16-byte row, and a key with ``m`` fingerprints costs
``m**2`` bit-sliced steps over its cells; copies of a text, however many,
cost nothing as they share a fingerprint.

Nulls and texts without words have fingerprint zero, which links like any
other.  A row without ``doc_id`` gets its fingerprint and a null component, and
links nothing.  Rows of one id come back each with its own fingerprint; the
component of a repeated id is that of its row's fingerprint.  Ties cannot
occur: a component is named by its smallest id.  Very long texts are hashed
in slices of bounded size.  Empty tables give no rows.  Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import connected_components, join_spread, written
from playlens.llm.textblocks import Block, blocks

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
SLICE = 1 << 15         # shingles hashed at a time
KEY_ROWS = 4096         # members of a key aimed at
CELL_ROWS = 16384       # members of a block of a cell
QUERIES = 128           # fingerprints compared at a time
PLANES = 8              # planes counted before words are abandoned
BITS = 64

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (    # the primes of XXH64
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of the byte spans of ``data``, which has 8 bytes of padding after the last span."""
    first = [np.uint64(v % (1 << 64)) for v in (seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1))]
    lanes = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    fours = np.ndarray((len(data) - 3,), "<u4", np.ascontiguousarray(data), strides=(1,))
    at, length = starts.astype(np.int64), (ends - starts).astype(np.int64)
    out = np.full(len(at), np.uint64((seed + int(_P5)) % (1 << 64)), dtype=np.uint64)
    long = np.flatnonzero(length >= 32)
    if len(long):
        begin, stripes = at[long], length[long] // 32
        acc = [np.full(len(long), v, dtype=np.uint64) for v in first]
        for k in range(int(stripes.max())):
            on = np.flatnonzero(stripes > k)
            for lane in range(4):
                acc[lane][on] = _round(acc[lane][on], lanes[begin[on] + 32 * k + 8 * lane])
        total = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
        for lane in range(4):
            total = (total ^ _round(np.zeros_like(total), acc[lane])) * _P1 + _P4
        out[long] = total
    out += length.astype(np.uint64)
    at = at + length // 32 * 32
    left = length % 32
    for _ in range(3):
        on = np.flatnonzero(left >= 8)
        if len(on):
            out[on] = _turn(out[on] ^ _round(np.zeros(len(on), np.uint64), lanes[at[on]]), 27) * _P1 + _P4
            at[on] += 8
            left[on] -= 8
    on = np.flatnonzero(left >= 4)
    if len(on):
        out[on] = _turn(out[on] ^ (fours[at[on]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
    for _ in range(3):
        on = np.flatnonzero(left > 0)
        if len(on):
            out[on] = _turn(out[on] ^ (data[at[on]].astype(np.uint64) * _P5), 11) * _P1
            at[on] += 1
            left[on] -= 1
    out ^= out >> np.uint64(33)
    out *= _P2
    out ^= out >> np.uint64(29)
    out *= _P3
    return out ^ (out >> np.uint64(32))


def fingerprints(block: Block, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The 64-bit fingerprint of each text of a block."""
    starts, ends, first = block.words()
    width = ends - starts
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(width + 1)])     # where each word stands when single spaces part them
    data = np.full(begin[-1] + 8, 0x20, dtype=np.uint8)
    if len(starts):
        source = np.repeat(starts - begin[:-1], width) + np.arange(width.sum()) + np.repeat(np.arange(len(width)), width)
        place = np.arange(width.sum()) + np.repeat(np.arange(len(width)), width)
        raw = block.data[source]
        raw[(raw >= 65) & (raw <= 90)] += 32
        data[place] = raw
    words = np.diff(first)
    counts = np.where(words >= size, words - size + 1, (words > 0).astype(np.int64))
    from_word = np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    to_word = from_word + np.repeat(np.minimum(words, size), counts) - 1
    owner = np.repeat(np.arange(block.n), counts)
    ones = np.zeros((block.n, BITS), dtype=np.int64)
    for lo in range(0, len(from_word), SLICE):
        cut = slice(lo, lo + SLICE)
        hashes = xxh64(data, begin[from_word[cut]], begin[to_word[cut]] + width[to_word[cut]])
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        who, at = np.unique(owner[cut], return_index=True)
        ones[who] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    over = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint_rows(size: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.lo, block.n), pa.array(fingerprints(block, size).view(np.int64))], ["doc_id", "fp"])
    return run


def tables(n: int, radius: int = RADIUS, rows: int = KEY_ROWS, limit: int = 8) -> list[int]:
    """Bit masks of the keys: any two fingerprints within ``radius`` agree on all bits of one of them.

    Few tables while ``n`` fingerprints need short keys; more blocks, hence more
    tables with longer keys, as ``n`` grows.
    """
    need = max(0, (max(n, 1) - 1).bit_length() - (rows.bit_length() - 1))
    if need == 0:
        return [0]
    for parts in range(radius + 1, radius + limit):
        edges = [BITS * i // parts for i in range(parts + 1)]
        kept = parts - radius
        if kept * (BITS // parts) >= need or parts == radius + limit - 1:
            break
    out = []
    for chosen in combinations(range(parts), kept):
        share, more = divmod(min(need, kept * (BITS // parts)), kept)
        out.append(sum(((1 << (share + (i < more))) - 1) << edges[c] for i, c in enumerate(chosen)))
    return out


def planes_of(values: np.ndarray) -> np.ndarray:
    """(64, words): plane j holds bit j of 64 members in each word; missing members are zero."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, dtype="<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near(queries: np.ndarray, planes: np.ndarray, radius: int = RADIUS, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) positions at distance ``radius`` (at most 7) or less.

    ``skip`` gives for each query a number of leading words to leave out.
    """
    words = planes.shape[1]
    q = np.repeat(np.arange(len(queries)), words)
    w = np.tile(np.arange(words), len(queries))
    if skip is not None:
        on = w >= skip[q]
        q, w = q[on], w[on]
    ones, twos, fours, over = (np.zeros(len(q), dtype=np.uint64) for _ in range(4))
    for lo in range(0, BITS, PLANES):
        if not len(q):
            break
        flip = [np.uint64(0) - (queries >> np.uint64(j) & np.uint64(1)) for j in range(lo, lo + PLANES)]
        for j in range(PLANES):
            x = planes[lo + j][w] ^ flip[j][q]
            carry = ones & x
            ones ^= x
            x = twos & carry
            twos ^= carry
            over |= fours & x
            fours ^= x
        beyond = over.copy()
        for bits in range(radius + 1, 8):      # counts over the radius that the three counters show
            hit = np.full(len(q), ~np.uint64(0))
            for k, counter in enumerate((ones, twos, fours)):
                hit &= counter if bits >> k & 1 else ~counter
            beyond |= hit
        live = np.flatnonzero(~beyond)
        if len(live) < len(q):
            q, w, ones, twos, fours, over = (a[live] for a in (q, w, ones, twos, fours, over))
            beyond = beyond[live]
    if not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(bits)
    return q[row], w[row] * 64 + lane


def links_between(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (left position, right position) that join all members within ``radius``; ``right is left`` compares one block.

    At most one link for each member: a link within what is joined already is left out.
    """
    same = right is left
    planes = planes_of(right)
    group_l = np.arange(len(left))
    group_r = group_l if same else np.arange(len(left), len(left) + len(right))
    links = []
    for lo in range(0, len(left), QUERIES):
        chunk = left[lo:lo + QUERIES]
        skip = np.full(len(chunk), lo // 64) if same else None
        q, member = near(chunk, planes, radius, skip)
        on = member < len(right)
        if same:
            on &= member > q + lo
        q, member = q[on], member[on]
        for i, begin, end in zip(*_runs(q)):
            x, others = int(i) + lo, member[begin:end]
            names = group_r[others]
            new, at = np.unique(names, return_index=True)
            mine = group_l[x]
            at, new = at[new != mine], new[new != mine]
            if not len(new):
                continue
            links += [(x, int(others[k])) for k in at]
            for group in (group_l,) if same else (group_l, group_r):
                group[np.isin(group, new)] = mine
    return links


def _runs(q: np.ndarray):
    if not len(q):
        return [], [], []
    begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    return q[begin], begin, np.append(begin[1:], len(q))


def _cell(radius: int):
    def run(key, table):
        i, j = key[2].as_py(), key[3].as_py()
        ids, values, block = (table.column(c).to_numpy() for c in ("rep", "fp", "block"))
        order = np.argsort(ids, kind="stable")
        ids, values, block = ids[order], values[order].view(np.uint64), block[order]
        left = block == i
        right = block == j
        a, b = ids[left], ids[right]
        one = values[left]
        links = links_between(one, one if i == j else values[right], radius)
        return pa.table({"a": pa.array([int(a[x]) for x, _ in links], pa.int64()), "b": pa.array([int(b[y]) for _, y in links], pa.int64())})
    return run


def simhash_groups(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS,
                   key_rows: int = KEY_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of documents linked at ``radius`` differing bits or fewer."""
    if not 0 <= radius <= 7:
        raise ValueError("the counters hold radii of 0 to 7")
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = written(base.mapInArrow(_fingerprint_rows(shingle_words), "doc_id long, fp long"), "fingerprints")
    reps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "reps")
    linked = reps.filter("rep is not null")
    masks = tables(linked.count(), radius, key_rows)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = linked.select("rep", "fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("t", "mask"))
    dealt = dealt.select("rep", "fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    wide = written(dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "keys")
    dealt = (join_spread(dealt.withColumn("tk", F.struct("t", "key")), wide.select(F.struct("t", "key").alias("tk"), "n"), "tk")
             .filter("n is not null").withColumn("n_blocks", F.ceil(F.col("n") / cell_rows).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
             .select("rep", "fp", "block", "t", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    links = dealt.groupBy("t", "key", "i", "j").applyInArrow(_cell(radius), "a long, b long")
    groups = connected_components(links).select(F.col("node").alias("rep"), "component")
    named = written(reps.join(groups, "rep", "left").select("fp", "n", F.coalesce("component", "rep").alias("component_id")), "named")
    out = join_spread(rows, named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
