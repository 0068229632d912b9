"""Training samples stay whole at any size: fine thresholds, every language, one row per label id."""

import pytest
from pyspark.sql import functions as F

from strataward.llm.common import chosen
from strataward.llm.language import prototypes, training_rows
from strataward.llm.toxicity import Training, train


@pytest.mark.parametrize("rows, wanted", [(10**11, 20_000), (10**13, 8_000), (10**17, 300)])
def test_threshold_is_fine_at_any_size(spark, rows, wanted):
    """The share of the hash range that is chosen, read off the smallest hash that is not."""
    share = wanted / rows
    cut = spark.range(1).select((F.lit(share) * 2.0**62).cast("long")).first()[0]
    assert cut / 2**62 * rows == pytest.approx(wanted, rel=0.01)


def test_sample_has_its_share(spark):
    n = spark.range(400_000).where(chosen(F.lit(0.01), "id")).count()
    assert 3600 < n < 4400
    assert spark.range(1000).where(chosen(F.lit(3.0), "id")).count() == 1000
    assert spark.range(1000).where(chosen(F.lit(0.0), "id")).count() == 0


def test_rare_language_keeps_its_rows(spark):
    big = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("the text "), "id").alias("text"))
    rare = spark.range(300).select((F.col("id") + 100_000).alias("doc_id"), F.lit("eo").alias("lang"), F.concat(F.lit("la teksto "), "id").alias("text"))
    same = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("xx").alias("lang"), F.lit("same row").alias("text"))
    got = {r["lang"]: r["count"] for r in training_rows(big.union(rare).union(same), 500).groupBy("lang").count().collect()}
    assert got["eo"] == 300 and 380 < got["en"] < 620 and got["xx"] == 5000


def test_every_language_is_learned(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 500 == 0, "eo").otherwise("en").alias("lang"), F.concat(F.lit("word text "), "id").alias("text")
    )
    assert prototypes(rows, 20)[0] == ["en", "eo"]


def test_one_training_row_per_label_id(spark):
    """Half of all documents carry one id: the fit gets one of them."""
    docs = spark.range(600).select(
        F.when(F.col("id") < 300, F.lit(1)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "bad awful words here").otherwise("kind clean words there").alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("low_quality"), (F.col("doc_id") % 2 == 0).cast("int").alias("toxic")).distinct()
    chain = train(docs, labels, t=Training(max_rows=1000))
    assert chain is not None and len(chain.weights) == 2
    assert train(docs, labels.where("false")) is None
