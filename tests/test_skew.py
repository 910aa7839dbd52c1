from pyspark.sql import functions as F

from floodplan.operators.skew import heavy_keys, spread_join


def frames(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100).alias("k")
    )
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return rows, lookup, rows.groupBy("k").agg(F.count("*").alias("n"))


def test_same_rows_as_a_plain_join(spark):
    rows, lookup, sizes = frames(spark)
    for how in ("inner", "left", "left_anti"):
        spread = spread_join(rows, lookup, ["k"], "id", sizes, how, shares=10)
        plain = rows.join(lookup, ["k"], how)
        assert spread.columns == plain.columns
        assert spread.exceptAll(plain).count() == 0 == plain.exceptAll(spread).count()


def test_heavy_keys_are_cut_and_few(spark):
    _, _, sizes = frames(spark)
    heavy = {r["k"]: r["parts"] for r in heavy_keys(sizes, ["k"], 10).collect()}
    assert heavy == {0: 4}


def test_keys_are_split_whatever_the_size_and_no_job_runs_before(spark):
    rows, lookup, sizes = frames(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "")
    joined = spread_join(rows.limit(5), lookup, ["k"], "id", sizes)
    assert not tracker.getJobIdsForGroup("spread")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "xxhash64" in joined._jdf.queryExecution().toString()
