import corpus_pipeline


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, small), "test")
        assert docs.columns == names and 0 < docs.count() <= count, name
        count = docs.count()
    done = corpus_pipeline.run(spark, small)
    assert done.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert done.count() == count
    assert done.where("n_tokens = 0").count() == 0


def test_copies_that_line_dedup_empties_go(spark, small):
    """A later copy has no line of its own; other documents keep theirs."""
    lines = "\n".join(f"line {i} of a text has some words in it" for i in range(12))
    rows = [(1, lines), (2, lines), (3, f"{lines}\nand its own end"), (4, "short"), (5, None), (6, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    done = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, small).collect()}
    assert done == {1: lines, 3: "and its own end", 4: "short"}


def test_scratch_of_the_stage_before_goes(spark, small, odd_docs):
    corpus_pipeline.quality_rules(spark, odd_docs, small).count()
    kept = list(corpus_pipeline._kept[spark.sparkContext.applicationId])
    corpus_pipeline.line_dedup(spark, odd_docs, small).count()
    now = corpus_pipeline._kept[spark.sparkContext.applicationId]
    assert now and not set(kept) & set(now)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    exists = [hadoop(p).getFileSystem(conf).exists(hadoop(p)) for p in kept + now]
    assert exists == [False] * len(kept) + [True] * len(now)


def test_odd_rows(spark, small, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, small)
            assert found.count() <= docs.count()
