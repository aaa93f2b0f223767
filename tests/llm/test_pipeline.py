import corpus_pipeline
from test_text_operators import prose


def test_pipeline_keeps_and_drops(spark, tmp_path):
    item = prose(1, 40)
    base = prose(2, 200)
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    rows = [
        (1, base, "en", "a", 0), (2, base, "en", "a", 0), (3, near, "en", "b", 0), (4, "12345 !!", "en", "a", 0), (5, "x " + item + " y", "en", "a", 0),
        (6, prose(3, 100) + " mail a.b@corp.com", "en", "c", 0), (7, None, None, None, None),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(sorted({r.doc_id for r in docs.collect()}))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "surrogates":
            assert not docs.filter("text like '%corp.com%'").count()
    assert kept == [[1, 2, 3, 5, 6], [1, 5, 6], [1, 6], [1, 6], [1, 6]]
    assert sorted({r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}) == [1, 6]
