"""The sums that tell whether a round of components changed anything."""

from pyspark.sql import functions as F

from tradewind.llm import components


def test_state_of_many_links(spark):
    links = spark.range(20_000_000).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert components._state(links)[0] == 20_000_000
