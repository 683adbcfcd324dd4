from pyspark.sql import functions as F

from tessitura.plans.ranking import global_rank


def test_every_place_once(spark):
    """Many rows over many ranges: each place comes once, and in order."""
    rows = spark.range(200_000).repartition(8).select("id", (F.xxhash64("id") % 1000).alias("score"))
    got = global_rank(rows, [F.desc("score"), F.col("id")], "place").toPandas().sort_values("place")
    assert got["place"].tolist() == list(range(1, 200_001))
    keys = list(zip(-got["score"], got["id"], strict=True))
    assert keys == sorted(keys)


def test_no_rows(spark):
    assert global_rank(spark.range(0), [F.col("id")], "place").count() == 0
