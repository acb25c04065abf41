"""Quality rules: zstandard compression bands over whole texts and fixed chunks.

Repetitive text compresses far below prose of its length, random text hardly
at all.  A text is rejected when the ratio ``compressed / raw`` of the whole
text leaves the band of its length class, or when more than
:data:`BAD_CHUNK_SHARE` of its :data:`CHUNK_BYTES` chunks leave their band: the
chunk band if full, else (the last one) that of their length class.  Upper limits
lie between the highest ratio of labelled prose (sf0.1) and the lowest of random
base64 words of the class.  Under 128 bytes the two overlap and the upper limit
cannot fire; under 64 bytes nothing is judged, and a shorter last chunk is no chunk.
Random words of few letters (hex, a-z) compress like short prose and are kept.

Beside the verdict each text gets the plain counts a rule set starts from:
words, code points in words, symbols, repeated lines, and words inside
three-word windows that occur twice or more.  Null and empty texts have no
words, ratio null and fail the word minimum.  Every row comes back once per
input row, repeated ones too; an empty table gives no rows.  Very long texts are
read whole.  Other columns are ignored.  Work is one map over the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.textblocks import blocks, fmix64

LEVEL = 3
CHUNK_BYTES = 1024
#: (bytes at least, lowest ratio, highest ratio) of whole texts
BANDS = ((0, 0.0, float("inf")), (64, 0.25, 1.70), (128, 0.25, 0.94), (192, 0.25, 0.88), (256, 0.30, 0.83), (384, 0.30, 0.79),
         (512, 0.30, 0.75), (1024, 0.28, 0.67), (4096, 0.25, 0.61), (16384, 0.20, 0.61), (65536, 0.15, 0.61))
CHUNK_BAND = (0.30, 0.69)
BAD_CHUNK_SHARE = 0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_bytes long, ratio double, n_chunks long, n_bad_chunks long")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeat_words(block, first: np.ndarray) -> np.ndarray:
    """Words covered by a three-word window that its text holds at least twice."""
    windows, begin = block.shingles(3, False, lower=False)
    out = np.zeros(block.n, dtype=np.int64)
    if not len(windows):
        return out
    owner = block.owners(begin)
    keys = fmix64(windows + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    ranked = keys[order]
    twin = np.zeros(len(keys), dtype=bool)
    equal = ranked[1:] == ranked[:-1]
    twin[1:] |= equal
    twin[:-1] |= equal
    hit = order[twin]
    covered = np.zeros(first[-1] + 3, dtype=bool)
    at = first[owner[hit]] + hit - begin[owner[hit]]
    for j in range(3):
        covered[at + j] = True
    return _per_text(covered[:first[-1]], first)


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _band(size: int) -> tuple[float, float]:
    return CHUNK_BAND if size == CHUNK_BYTES else next(b[1:] for b in reversed(BANDS) if size >= b[0])


def _measure(batches):
    import zstandard
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    for batch in batches:
        for block in blocks(batch):
            starts, ends, first = block.words()
            inside = np.zeros(len(block.data) + 1, dtype=np.int8)
            inside[starts] += 1
            inside[ends] -= 1
            in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            # neighbouring texts may touch: a start at the former's end cancels its -1, which is right
            point = in_word & ((block.data & 0xC0) != 0x80)
            n_bytes = np.diff(block.offsets)
            ratios, chunks, bad, dups = [], [], [], []
            for i in range(block.n):
                raw = block.text(i)
                ratios.append(len(packer.compress(raw)) / len(raw) if raw else None)
                parts = [raw[k:k + CHUNK_BYTES] for k in range(0, len(raw), CHUNK_BYTES)]
                if parts and len(parts[-1]) < BANDS[1][0]:
                    parts.pop()
                chunks.append(len(parts))
                bad.append(sum(not low <= len(packer.compress(p)) / len(p) <= high for p in parts for low, high in [_band(len(p))]))
                dups.append(_dup_lines(raw))
            yield pa.RecordBatch.from_arrays([
                pc.cast(batch.column(0).slice(block.lo, block.n), pa.int64()),
                pa.array(np.diff(first)), pa.array(_per_text(point, block.offsets)),
                pa.array(_per_text(symbol[block.data], block.offsets)), pa.array(dups, pa.int64()),
                pa.array(_repeat_words(block, first)), pa.array(n_bytes), pa.array(ratios, pa.float64()),
                pa.array(chunks, pa.int64()), pa.array(bad, pa.int64()),
            ], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "n_bytes", "ratio", "n_chunks", "n_bad_chunks"])


def compression_report(docs: DataFrame) -> DataFrame:
    """Counts, ratios and verdicts (``base_failed``, ``in_band``, ``kept``) per document."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(_measure, SCHEMA)
    band = F.lit(True)
    for least, lowest, highest in BANDS:     # the last class that fits decides
        inside = F.col("ratio") >= lowest
        if highest != float("inf"):
            inside = inside & (F.col("ratio") <= highest)
        band = F.when(F.col("n_bytes") >= least, inside).otherwise(band)
    in_band = F.coalesce(band, F.lit(True)) & (F.col("n_bad_chunks") <= BAD_CHUNK_SHARE * F.col("n_chunks"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (rows.withColumn("base_failed", failed).withColumn("in_band", in_band)
            .withColumn("kept", ~F.col("base_failed") & F.col("in_band")))
