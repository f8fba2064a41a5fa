"""The pipeline on a small folder, against plain versions of its stages."""

import corpus_pipeline
from pyspark.sql import functions as F

from evenkeel.llm import texts


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [f"{n} {k}" for n, k in docs.dtypes]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.select("*", F.lit("clash").alias("Text")), folder)
        assert [f"{n} {k}" for n, k in out.dtypes] == names, name
        assert stage(spark, docs.limit(0), folder).count() == 0
    ids = corpus_pipeline.run(spark, folder)
    assert ids.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    assert 0 < ids.count() <= docs.count()
    assert ids.where(F.size("ids") != F.col("n_tokens")).isEmpty()


def test_near_copies_by_row(spark):
    def text(k):
        return " ".join(f"w{k}x{i}" for i in range(60))

    near = text(0) + " end"
    rows = [
        (3, text(0), "en", "a", 1), (5, near, "en", "a", 2), (5, text(1), "en", "a", 3),  # 5 is used again
        (None, text(2), "en", "a", 4), (None, text(3), None, "a", 5), (None, text(3), "a", None, 5),
        (None, text(4), "en", "a", 6), (7, text(4), "en", "a", 6), (8, text(5), "en", "a", 7), (8, text(5), "en", "a", 7),
        (9, None, "en", "a", 0), (9, " \n", "en", "a", 0), (None, "", "en", "a", 0), (None, "", "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [tuple(r) for r in corpus_pipeline.near_copies(spark, docs.repartition(3), "").collect()]
    worded = sorted((r[1], r[0]) for r in kept if r[1] and r[1].strip())
    assert worded == sorted([(text(0), 3), (text(1), 5), (text(2), None), (text(3), None), (text(4), 7), (text(5), 8)])
    assert sorted(map(str, (r for r in kept if not (r[1] and r[1].strip())))) == sorted(map(str, rows[-4:]))


def test_null_id_is_not_smallest(spark):
    docs = spark.createDataFrame([(None, "one two three four five"), (7, "one two three four five")], "doc_id long, text string")
    assert {r.component_id for r in corpus_pipeline.jaccard_join(docs).collect()} == {7}


def test_near_copies_leave_most_texts_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(texts, "MARKS", 1 << 16)  # so small that rows hit marks of others
    folder = spark.range(6000).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(0, 9), i -> concat('w', i, 'x', id - if(id % 2 = 1 AND id < 4000, 1, 0)))) AS text",
        "'en' AS lang", "'a' AS source", "1L AS n_chars")
    twice = folder.unionByName(folder.where("doc_id % 500 = 0"))
    kept = corpus_pipeline.near_copies(spark, twice, "")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [*range(0, 4000, 2), *range(4000, 6000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus_pipeline.near_copies(spark, folder, "")._jdf.queryExecution().sparkPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first = plan.children().apply(0).toString()
    assert plan.nodeName() == "Union" and "Join" not in first and "Exchange" not in first
