import pytest


@pytest.fixture(autouse=True)
def _prepared(spark, tmp_path_factory):
    from strataward.llm.common import prepare

    prepare(spark)


@pytest.fixture
def docs(spark):
    """Build a documents frame from texts or (id, text) pairs, with columns whose names operators use inside."""

    def build(rows, **extra):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, n long, name string, kept string, row int, bucket string"
        full = [(k, t, extra.get("lang", {}).get(k, "en"), "s", len(t or ""), f"r{i}", i, None, "k", i, "b") for i, (k, t) in enumerate(pairs)]
        return spark.createDataFrame(full, schema)

    return build
