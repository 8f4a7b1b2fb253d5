from pyspark.sql import functions as F

from sluicegate.operators.lookup import fits_broadcast, lookup


def _sides(spark):
    # One key holds a third of all rows; some keys have no match and some are null.
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), F.col("id") % 40)
    )
    big = spark.range(6000).select(F.col("id").alias("seq"), key.alias("table"))
    small = spark.range(20).select(F.concat(F.lit("k"), F.col("id")).alias("table"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("hot", 99)], "table string, v bigint")
    )
    return big, small


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_size_check(spark):
    small = spark.range(50).select(F.col("id").cast("string").alias("table"))
    assert fits_broadcast(small, max_rows=50)
    assert not fits_broadcast(small, max_rows=49)
    assert not fits_broadcast(small, max_bytes=100)
    assert fits_broadcast(small.limit(0), max_rows=0, max_bytes=0)


def test_salted_join_gives_the_same_rows(spark):
    big, small = _sides(spark)
    for how in ("left", "inner", "left_anti", "left_semi"):
        right = small.select("table") if how in ("left_anti", "left_semi") else small
        broadcast = lookup(big, right, "table", F.col("seq"), how)
        salted = lookup(big, right, "table", F.col("seq"), how, max_rows=3, salts=8)
        assert broadcast.columns == salted.columns
        assert "Broadcast" in _plan(broadcast) and "SortMergeJoin" in _plan(salted)
        assert sorted(map(str, broadcast.collect())) == sorted(map(str, salted.collect()))


def test_salted_join_spreads_the_hot_key(spark):
    big, small = _sides(spark)
    salted = lookup(big, small, "table", F.col("seq"), max_rows=3, salts=16)
    spread = (
        salted.where("table = 'hot'")
        .groupBy(F.pmod(F.xxhash64("seq"), F.lit(16)))
        .count()
        .agg(F.max("count").alias("most"), F.sum("count").alias("all"))
        .first()
    )
    assert spread["all"] == 2000 and spread["most"] < 2 * 2000 / 16
