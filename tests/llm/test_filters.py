import re
import zlib

import pytest

from cases import ITEM, LABEL, awkward, empty, nothing, words
from playlens.llm import compression as cp
from playlens.llm import decontaminate as dc
from playlens.llm import quality_gam as qg
from playlens.llm import toxicity as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The base counts of a text, one word and one window at a time."""
    text = text or ""
    w = WORD.findall(text)
    seen, covered = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + j for i in at for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("table", ["sf0.001", "awkward"])
def test_compression_counts(spark, table):
    docs = awkward(spark) if table == "awkward" else spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
    want = sorted((str(r["doc_id"]), *counts(r["text"])) for r in docs.collect())
    got = cp.compression_report(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_compression_verdicts(spark):
    import random
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    prose = " ".join("".join(rng.choices(letters, weights=range(1, 27), k=rng.randint(2, 9))) for _ in range(400))
    block = " ".join("".join(rng.choices(letters, k=5)) for _ in range(60))
    noise = " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) + chr(rng.randint(33, 126)) for _ in range(6)) for _ in range(200))
    half = prose + "\n" + ("ab cd " * 500)
    docs = spark.createDataFrame([(1, prose), (2, "\n".join([block] * 30)), (3, noise), (4, half)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in cp.compression_report(docs).collect()}
    assert got[1]["kept"] and not got[2]["kept"]
    assert got[4]["n_bad_chunks"] >= 2 and not got[4]["in_band"]
    assert got[3]["ratio"] > got[1]["ratio"]
    assert cp.compression_report(empty(spark)).count() == 0
    assert [r["kept"] for r in cp.compression_report(nothing(spark)).collect()] == [False] * 3


def test_compression_rejects_random_text_of_every_length(spark):
    import random
    rng = random.Random(3)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    ascii_ = "".join(map(chr, range(33, 127)))

    def noise(alphabet, n):
        return " ".join("".join(rng.choices(alphabet, k=8)) for _ in range(n // 9 + 1))[:n]
    sizes = (128, 191, 192, 255, 256, 383, 384, 511, 512, 700, 1023, 1024, 2000, 4095, 4096, 6000, 16384, 30000, 65536, 90000)
    rows = [(i, noise(a, n)) for i, (n, a) in enumerate((n, a) for n in sizes for a in (base64, ascii_))]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    prose = [r["text"] for r in docs.join(labels, "doc_id").filter("quality = 1").orderBy("doc_id").collect()]
    whole = next(t[:3072] for t in prose if len(t) >= 3072 and t[:3072].isascii())
    rows += [(1000, whole), (1001, whole + noise(ascii_, 700)), (1002, whole + " " * 10)]
    rows += [(2000 + i, t) for i, t in enumerate(prose)]
    got = {r["doc_id"]: r for r in cp.compression_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [d for d in got if d < 1000 and got[d]["in_band"]] == []
    assert [(got[d]["n_chunks"], got[d]["n_bad_chunks"], got[d]["in_band"]) for d in (1000, 1001, 1002)] == [(3, 0, True), (4, 1, False), (3, 0, True)]
    assert all(r["in_band"] for d, r in got.items() if d >= 2000)


def contained(docs, items, num=80, den=100):
    def sh(t):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    sets = [(i, sh(t)) for i, t in items]
    out = []
    for d, t in docs:
        own = sh(t)
        out += [(d, i, len(s), len(s & own)) for i, s in sets if s and den * len(s & own) >= num * len(s)]
    return sorted(out, key=str)


def test_decontamination_matches_brute_force(spark):
    long_item = words(3, 700)
    items = [(1, words(1, 30)), (2, words(2, 12)), (3, long_item), (4, "a b"), (5, None), (6, words(4, 7)), (None, words(5, 40))]
    noise = [words(1000 + k, 300) for k in range(40)]
    part = words(1, 30).split()
    docs = [(k, noise[k] + " " + t + " " + noise[-k - 1]) for k, t in enumerate([
        words(1, 30), words(2, 12), long_item, "a b", words(4, 7), words(5, 40), " ".join(part[:27]), " ".join(part[:20]),
        " ".join(part[:14]) + " zz " + " ".join(part[14:])])]
    docs += [(20, None), (21, ""), (22, words(1, 30)), (22, words(1, 30))]
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEM))
    assert sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in got.collect()), key=str) == contained(docs, items)


def test_decontamination_in_blocks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = contained([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    for limit in (dc.ITEM_SHINGLES, 300):
        monkeypatch.setattr(dc, "ITEM_SHINGLES", limit)
        got = dc.contaminated(docs, items).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in got), key=str) == want


def test_decontamination_awkward(spark):
    items = spark.createDataFrame([(1, words(1, 100))], ITEM)
    got = {r["doc_id"] for r in dc.contaminated(awkward(spark), items).collect()}
    assert got == {1, 2, 3}
    assert dc.clean_documents(awkward(spark), items).count() == 12
    assert dc.contaminated(empty(spark), items).count() == 0
    assert dc.contaminated(awkward(spark), spark.createDataFrame([], ITEM)).count() == 0


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = [f"word{zlib.crc32(f'{i}/{j}'.encode()) % 200}" for j in range(60)]
        if bad:
            text[10 + i % 30] = ("vilest", "nasty")[i % 8 // 4]
        rows.append((i, " ".join(text)))
        labels.append((i, int(not bad), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABEL)


def test_training_sample_is_full_where_long_texts_abound(spark):
    from playlens.llm.labelled import training_rows
    rows = [(i, "a b c" if i % 4 == 0 else "a b c d e f") for i in range(200)] + [(0, "a b c"), (4, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 8 // 4, i % 8 // 4) for i in range(0, 200)], LABEL)
    got = training_rows(docs, labels, "toxic", 5, 0, 10, 3).collect()
    assert sorted(r["label"] for r in got) == [0] * 10 + [1] * 10
    assert all(r["doc_id"] % 4 == 0 and r["text"] == "a b c" for r in got)
    plan = training_rows(docs, labels, "toxic", 5, 0, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("TakeOrderedAndProject") >= 2


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark)
    got = tx.toxicity_scores(docs, labels).collect()
    assert len(got) == 400 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    again = {r["doc_id"]: r["score"] for r in tx.toxicity_scores(docs, labels).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in got)


def test_toxicity_awkward(spark):
    docs, labels = labelled(spark, 60)
    got = tx.toxicity_scores(awkward(spark), labels).collect()
    assert len(got) == 15 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (4, 5, 6))
    none = spark.createDataFrame([], LABEL)
    assert {r["score"] for r in tx.toxicity_scores(docs, none).collect()} == {0.0}
    assert tx.toxicity_scores(empty(spark), labels).count() == 0
    kept = tx.clean_documents(awkward(spark), labels)
    assert kept.columns == awkward(spark).columns and kept.count() <= 15


def test_toxicity_gradients():
    import numpy as np
    import pyarrow as pa
    from playlens.llm.textblocks import blocks
    m = tx.new_model(np.random.default_rng(3))
    batch = pa.RecordBatch.from_arrays([pa.array(["aa bb cc " * 20, "x", "the cat sat " * 11])], ["text"])
    block = next(blocks(batch))
    inverse, word, grams, begin = tx.word_inputs(block)
    vectors = tx._vectors(m, word, grams, begin)
    text, start, length = tx.windows_of(block.words()[2])
    assert (np.bincount(text) > 0).all() and length.min() == 1
    m = {k: v.astype(np.float64) for k, v in m.items()}
    labels = np.array([1.0, 0.0, 1.0])
    grad, _, _ = tx._gradients(m, vectors, inverse, text, start, length, labels)
    for name in ("out", "query", "attend", "bias"):
        at = (0,) * m[name].ndim
        steps = []
        for sign in (1, -1):
            m[name][at] += sign * 1e-4
            steps.append(tx._gradients(m, vectors, inverse, text, start, length, labels)[2])
            m[name][at] -= sign * 1e-4
        assert abs((steps[0] - steps[1]) / 2e-4 - grad[name][at]) < 1e-3


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = qg.quality_scores(docs, labels).collect()
    assert len(got) == 1000
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_quality_awkward(spark):
    docs, labels = labelled(spark, 60)
    got = qg.quality_scores(awkward(spark), labels).collect()
    assert len(got) == 15 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in qg.quality_scores(docs, spark.createDataFrame([], LABEL)).collect()} == {0.0}
    assert qg.quality_scores(empty(spark), labels).count() == 0
