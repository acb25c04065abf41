import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cases import ITEM, LABEL, awkward, empty, words
from playlens.llm import decontaminate, mixing, near_dedup, toxicity
from test_filters import contained
from test_near_dedup import brute

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        steps.append((name, docs))
        if name != "sharding":
            assert docs.columns == columns
    stages = dict(steps)
    texts = {n: [(r["doc_id"], r["text"]) for r in stages[n].select("doc_id", "text").collect()] for n in list(stages)[:4]}
    groups = brute(texts["toxicity"], 80, 100)
    assert {d for d, _ in texts["near_dedup"]} == {d for d, (_, low) in groups.items() if d == low}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {h[0] for h in contained(texts["near_dedup"], items)}
    assert {d for d, _ in texts["decontamination"]} == {d for d, _ in texts["near_dedup"]} - hit
    size = sum(len(t.split()) for _, t in texts["decontamination"])
    assert abs(sum(len(t.split()) for _, t in texts["mixing"]) - 1.5 * size) < 0.01 * size
    assert docs.count() == len(texts["mixing"]) > 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


def test_awkward_rows(spark, tmp_path):
    spark.createDataFrame([(1, words(3, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0


def test_decontamination_judges_rows_by_their_own_text(spark, monkeypatch):
    item = words(3, 30)
    rows = [(None, f"before {item} after"), (4, f"{item} and more"), (4, words(5, 40)), (5, words(6, 40)), (None, words(7, 40)), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit(1.5))
    items = spark.createDataFrame([(1, item), (2, words(99, 30)), (3, None), (4, "too short")], ITEM)
    want = sorted((str(d), t) for d, t in rows if item not in (t or ""))
    for block in (1_000_000, 20):       # 20: several blocks of items
        monkeypatch.setattr(decontaminate, "ITEM_SHINGLES", block)
        out = decontaminate.clean_documents(docs, items)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == [(d, t) for d, t in want]
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()} == {(None, 1), (4, 1)}
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == len(rows)


def test_a_benchmark_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_SHINGLES", 60)
    items = [(i, words(500 + i, 20)) for i in range(60)]
    docs = [(i, words(i, 30) + " " + items[i][1]) for i in range(0, 60, 7)] + [(100 + i, words(900 + i, 60)) for i in range(10)]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEM)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()} == {(i, i) for i in range(0, 60, 7)}
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(docs, items).collect()) == list(range(100, 110))


@pytest.mark.parametrize("repeat", [False, True])
def test_mixing_takes_any_column_names(spark, repeat):
    docs = spark.createDataFrame([(i, words(i, 20 + i), "en", "ab"[i % 2], i) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    plain = docs.unionByName(docs.limit(3)) if repeat else docs
    want = sorted(r["doc_id"] for r in mixing.mixed_documents(plain).collect())
    named = plain
    for name in ("_copies", "_copy", "_turn", "_dsize", "_id", "_source", "_size", "copies", "copy", "row", "id", "of", "words", "hash", "turn", "place", "size", "a.b"):
        named = named.withColumn(name, F.lit(name))
    out = mixing.mixed_documents(named)
    assert out.schema.simpleString() == named.schema.simpleString()
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == want and all(r["_copies"] == "_copies" and r["a.b"] == "a.b" for r in rows)


def test_stages_on_empty_tables(spark, tmp_path):
    none, labels, items = empty(spark), spark.createDataFrame([], LABEL), spark.createDataFrame([], ITEM)
    for out in (toxicity.clean_documents(none, labels), near_dedup.one_of_each_group(none), decontaminate.clean_documents(none, items),
                mixing.mixed_documents(none)):
        assert out.columns == none.columns and out.count() == 0
    for name, table in (("documents", none), ("labels", labels), ("benchmark", items)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
