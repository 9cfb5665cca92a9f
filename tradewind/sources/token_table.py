"""A stored table of the words of texts, for searches that are made again and again.

``tokens`` has a row for each word, document and field: how often it occurs and how many words the field has. It is partitioned by
a hash of the word and sorted within files, so a search reads the partitions of its terms and skips blocks of
other words. ``frequencies`` has the number of documents of each word, ``ids`` the id of every document.

Words are counted inside their document, so an entry moves once, to its bucket. Documents of a word are counted in
every task first; only entries of ids that were written more than once are brought together by word and id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import text
from tradewind.session import stored

BUCKETS = 64


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _entries(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(id, size, token, count): each word of each field of a document, its count, and the field's size. With more than one field
    also the field's number ``k`` and whether no field before has the word (``first``).

    Equal words stand together in the sorted array of a document; a count is the distance between two starts. Only the starts are
    found inside the array, all else is taken from it row by row. With more than one field a word ends in its field's number.
    """
    several = len(fields) > 1
    words = [text.words(F.coalesce(F.col(f), F.lit(""))) for f in fields]

    def marked(ws: Column, k: int) -> Column:
        return F.transform(ws, lambda w: F.concat(w, F.lit(chr(k + 1)))) if several else ws

    def word(marked: Column) -> Column:
        return F.left(marked, F.length(marked) - 1) if several else marked

    new = lambda w, i: F.when((i == 0) | (w != F.get(F.col("ws"), i - 1)), i)
    docs = df.select(F.col(key).alias("id"), *(ws.alias(f"w{k}") for k, ws in enumerate(words)))
    docs = docs.select(
        "id",
        F.array(*(F.size(f"w{k}") for k in range(len(fields)))).alias("sizes"),
        F.sort_array(F.concat(*(marked(F.col(f"w{k}"), k) for k in range(len(fields))))).alias("ws"),
    )
    docs = docs.select("id", "sizes", "ws", F.array_compact(F.transform("ws", new)).alias("at"))
    after = F.slice("at", 2, F.greatest(F.size("at"), F.lit(1)))
    each = docs.select("id", "sizes", "ws", F.size("ws").alias("all"), F.inline(F.arrays_zip("at", after.alias("after"))).alias("start", "next"))
    here, before = F.get("ws", F.col("start")), F.get("ws", F.col("start") - 1)
    k = F.ascii(F.right(here, F.lit(1))) - 1 if several else F.lit(0)
    first = (F.col("start") == 0) | (word(before) != word(here))
    return each.select(
        "id",
        F.get("sizes", k).alias("size"),
        word(here).alias("token"),
        (F.coalesce("next", "all") - F.col("start")).cast("long").alias("count"),
        *([k.alias("k"), first.alias("first")] if several else []),
    )


def write_tokens(df: DataFrame, key: str, fields: list[str], path: str, buckets: int = BUCKETS, mode: str = "overwrite") -> None:
    """Store the words of the fields of ``df``; with ``mode="append"`` those of more documents. Every document is written once.

    A bucket is cut into as many files as its size asks for, so a very common word is not one task's.
    """
    spark = df.sparkSession
    each = _entries(df, key, fields)
    placed = each.select("*", _bucket(F.col("token"), buckets).alias("bucket")).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "token")
    # what is the same in all rows is neither shuffled nor sorted
    field, first = (F.get(F.array(*map(F.lit, fields)), F.col("k")), F.col("first")) if len(fields) > 1 else (F.lit(fields[0]), F.lit(True))
    entries = placed.select("token", "id", field.alias("field"), "count", "size", first.alias("first"), "bucket")
    entries.write.mode(mode).partitionBy("bucket").parquet(f"{path}/tokens")
    ids = df.select(F.col(key).alias("id"))
    ids.write.mode(mode).parquet(f"{path}/ids")
    tokens = spark.read.schema(entries.schema).parquet(f"{path}/tokens")
    # a document with a word in two fields counts once
    counts = [tokens.where("first")]
    again = stored(spark.read.schema(ids.schema).parquet(f"{path}/ids").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("again")), "repeated-ids")
    if not again.isEmpty():
        same = F.col("id").eqNullSafe(F.col("again"))
        counts = [counts[0].join(again, same, "left_anti"), tokens.join(again, same, "left_semi").select("bucket", "token", "id").distinct()]
    documents = reduce(DataFrame.unionByName, (c.select("bucket", "token") for c in counts)).groupBy("bucket", "token").agg(F.count(F.lit(1)).alias("documents"))
    documents.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/frequencies")


def _of_terms(table: DataFrame, terms: list[str], buckets: int) -> DataFrame:
    # hashes of literals are literals when the scan is planned: other partitions are not read
    return table.where(F.col("bucket").isin([_bucket(F.lit(t), buckets) for t in terms]) & F.col("token").isin(terms))


def search(spark: SparkSession, path: str, query: str, top: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(id, score) of the documents with a word of the query: over fields, the share of words that are searched for.

    The score is that of ``functions.text.text_score``. With ``top`` only the best, ties to the lowest id.
    """
    terms = text.search_terms(query)
    hits = _of_terms(spark.read.parquet(f"{path}/tokens"), terms, buckets)
    # shares are added up per field: as many words over one size
    fields = hits.groupBy("id", "field").agg((F.sum("count") / F.max("size")).alias("share"))
    found = fields.groupBy("id").agg(F.sum("share").alias("score"))
    return found if top is None else found.orderBy(F.desc("score"), "id").limit(top)


def frequencies(spark: SparkSession, path: str, terms: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(token, documents) of the given words, or of all."""
    table = spark.read.parquet(f"{path}/frequencies")
    return (table if terms is None else _of_terms(table, terms, buckets)).select("token", "documents")
