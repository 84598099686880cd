import corpus_pipeline
from strandwork.llm import decontaminate, near_dedup, quality

from .conftest import DOCS, doc, prose


def test_stages_in_turn(spark, tmp_path):
    """Every stage against its operator's own decisions, and planted cases through the whole run."""
    items = [(k, prose(700 + k, 25)) for k in range(5)]
    good = [doc(k, prose(k, 90), f"s{k % 3}") for k in range(150)]
    bad = [doc(1000 + k, " ".join(w.upper() + "!!" for w in prose(k, 30).split()), "s0") for k in range(60)]
    copies = [doc(2000 + k, prose(k, 90), "s2") for k in range(10)]
    leaks = [doc(3000 + k, prose(800 + k, 40) + " " + items[k][1] + " " + prose(850 + k, 40), "s1") for k in range(5)]
    docs = spark.createDataFrame(good + bad + copies + leaks, DOCS)
    tables = {"documents": docs, "benchmark": spark.createDataFrame(items, "item_id long, text string"), "labels": spark.createDataFrame([(d[0], int(d in good), 0) for d in good + bad], "doc_id long, quality int, toxic int")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    now, seen = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        now = spark.read.parquet(f"{tmp_path}/out{k}")
        if k < 4:
            assert now.columns == docs.columns
        seen[name] = (before, [r["doc_id"] for r in now.select("doc_id").collect()])
    ids = {n: set(v) for n, (_, v) in seen.items()}
    before = seen["quality_filter"][0]
    assert ids["quality_filter"] == {r["doc_id"] for r in quality.score(before, tables["labels"]).where("predicted = 1").collect()}
    assert not ids["quality_filter"] & {d[0] for d in bad} and ids["quality_filter"] >= {d[0] for d in good}
    before = seen["near_dedup_filter"][0]
    assert ids["near_dedup_filter"] == {r["doc_id"] for r in near_dedup.near_duplicates(before).where("kept").collect()} == ids["quality_filter"] - {d[0] for d in copies}
    before = seen["leak_filter"][0]
    assert ids["leak_filter"] == ids["near_dedup_filter"] - {r["doc_id"] for r in decontaminate.contamination(before, tables["benchmark"]).collect()} == ids["near_dedup_filter"] - {d[0] for d in leaks}
    assert ids["source_mix"] <= ids["leak_filter"]
    assert sorted(seen["shard_slots"][1]) == sorted(seen["source_mix"][1])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["shard_slots"][1])


def test_rows_of_every_kind_and_empty_tables(spark, edge, nothing, tmp_path):
    """Nulls in any column, blank and very long texts, copies and repeated rows through all stages; then no documents, labels or items."""
    for name, docs, more in (("edge", edge, 1), ("none", nothing, 0)):
        folder = f"{tmp_path}/{name}"
        tables = {
            "documents": docs,
            "benchmark": spark.createDataFrame([(1, prose(3, 60)), (2, None), (None, prose(77, 30))] * more, "item_id long, text string"),
            "labels": spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 0)] * more, "doc_id long, quality int, toxic int"),
        }
        for table, df in tables.items():
            df.write.parquet(f"{folder}/{table}.parquet")
        now = spark.read.parquet(f"{folder}/documents.parquet")
        kept = []
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            if k == 0:  # two labels can't tell good from bad: all rows pass on
                stage(spark, now, folder).count()
                continue
            stage(spark, now, folder).write.parquet(f"{folder}/out{k}")
            now = spark.read.parquet(f"{folder}/out{k}")
            assert k == 4 or now.columns == docs.columns
            kept.append(sorted((r["doc_id"] or 0) for r in now.select("doc_id").collect()))
        assert corpus_pipeline.run(spark, folder).count() >= 0
        if not more:
            assert kept == [[]] * 4
            continue
        dedup, clean, mix, shards = kept
        assert dedup == [0, 1, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13]  # copies once, rows without words all
        assert clean == [k for k in dedup if k != 3]
        assert set(mix) <= {k for k in clean if k not in (4, 5, 6, 13)} and shards == mix
