import pytest


@pytest.fixture(autouse=True)
def workers(spark):
    from marketlens.llm.queries import reach_workers
    reach_workers(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table of (doc_id, text, lang, source) rows, with columns whose
    names the operators use themselves; stored, as the operators ask for."""
    def make(rows, path):
        frame = spark.createDataFrame(
            [(i, t, lang, s, len(t or ""), "x", -1) for i, t, lang, s in rows],
            "doc_id long, text string, lang string, source string, n_chars long, key string, shard int")
        frame.repartition(3).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make
