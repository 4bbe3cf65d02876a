"""The aggregate forms equal the literal window forms of the source
pipeline on random data (ties broken by an explicit unique column)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from regpanel.operators import intervals as iv


def _random_snapshots(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        tin = f"t{rnd.randint(0, 40)}" if rnd.random() < 0.7 else "hot"
        state = rnd.choice(["A", "B", None])
        day = rnd.randint(0, 400)
        data.append((i, tin, state, day, rnd.choice(["x", "y", None])))
    df = spark.createDataFrame(data, "uid long, tin string, state string, day int, extra string")
    return df.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day")))


def test_state_hull_equals_window_form(spark):
    df = _random_snapshots(spark)
    keys = ["tin", "state"]
    w = Window.partitionBy(*keys).orderBy("d", "uid")
    ref = (df.withColumn("rn", F.row_number().over(w))
             .withColumn("end_date", F.last("d").over(w.rowsBetween(0, Window.unboundedFollowing)))
             .filter("rn = 1").select(*keys, "extra", F.col("d").alias("start_date"), "end_date"))
    got = iv.state_hull(df, keys, "d", carry=["extra"], tiebreak=["uid"])
    assert rows(got, *keys, "extra", "start_date", "end_date") == \
        rows(ref, *keys, "extra", "start_date", "end_date")


def test_latest_revision_equals_window_form(spark):
    df = _random_snapshots(spark).withColumn(
        "doc", F.when(F.col("uid") % 5 == 0, F.lit(None)).otherwise(F.col("day") % 37))
    a = iv.latest_revision(df.drop("d"), ["tin", "state"], "doc", tiebreak=["uid"],
                           method="aggregate")
    b = iv.latest_revision_window(df.drop("d"), ["tin", "state"], "doc", tiebreak=["uid"])
    assert rows(a, "tin", "state", "uid") == rows(b, "tin", "state", "uid")


def test_hull_last_end_equals_window_form(spark):
    df = (_random_snapshots(spark)
          .withColumn("end_date", F.when(F.col("uid") % 7 == 0, F.lit(None))
                      .otherwise(F.date_add("d", (F.col("uid") % 90).cast("int"))))
          .withColumnRenamed("d", "start_date"))
    keys = ["tin", "state"]
    w = Window.partitionBy(*keys).orderBy("start_date", "uid")
    ref = (df.withColumn("rn", F.row_number().over(w))
             .withColumn("end_date", F.last("end_date").over(
                 w.rowsBetween(0, Window.unboundedFollowing)))
             .filter("rn = 1").select(*keys, "start_date", "end_date"))
    got = iv.hull_last_end(df.select(*keys, "start_date", "end_date", "uid"), keys,
                           carry=[], tiebreak=["uid"])
    assert rows(got, *keys, "start_date", "end_date") == rows(ref, *keys, "start_date", "end_date")


def test_next_known_fill_equals_unbounded_following_window(spark):
    df = _random_snapshots(spark)
    w = (Window.partitionBy("tin").orderBy("d", "uid")
         .rowsBetween(0, Window.unboundedFollowing))
    ref = df.withColumn("f", F.first("extra", ignorenulls=True).over(w))
    got = iv.next_known_fill(df, "tin", ["d", "uid"], "extra", "f")
    assert rows(got, "uid", "f") == rows(ref, "uid", "f")


def test_bucketed_scans(spark):
    # Few and many buckets, whatever the batch size: the same rows.
    from regpanel.operators import scan
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = _random_snapshots(spark, n=1500, seed=5)
        w = (Window.partitionBy("tin").orderBy("d", "uid")
             .rowsBetween(0, Window.unboundedFollowing))
        ref = df.withColumn("f", F.first("extra", ignorenulls=True).over(w))
        got = iv.next_known_fill(df, "tin", ["d", "uid"], "extra", "f")
        assert rows(got, "uid", "f") == rows(ref, "uid", "f")
        vals = df.select("tin", F.col("day").cast("double").alias("v"))
        r = scan.value_ranks(vals, ["tin"], "v", buckets=5)
        ranked = {(t, v): b for t, v, _, b, _ in r.collect()}
        pdf = vals.toPandas()
        for (t, v), b in ranked.items():
            part = pdf[pdf["tin"] == t]
            assert b == int((part["v"] < v).sum())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_bucketed_fill_of_hot_and_null_keys(spark):
    # A hot key, a hot null key and small keys equal the window form.
    from regpanel.operators import scan
    rnd = random.Random(9)
    data = []
    for i in range(3000):
        k = None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"k{i % 50}")
        data.append((k, i, None if rnd.random() < 0.8 else float(i)))
    df = spark.createDataFrame(data, "k string, t long, v double").repartition(6)
    got = scan.bucketed_next_known(df, ["k"], ["t"], "v", "f", buckets=8)
    ref = iv.next_known_fill(df, "k", ["t"], "v", "f", method="window")
    assert rows(got, "k", "t", "f") == rows(ref, "k", "t", "f")
    assert set(got.columns) == set(ref.columns)


def test_bucketed_scans_under_a_union(spark):
    from regpanel.operators import scan
    df = _random_snapshots(spark, n=2000, seed=3)
    other = df.limit(50).withColumn("f", F.lit(None).cast("string")).repartition(5)
    filled = iv.next_known_fill(df, "tin", ["d", "uid"], "extra", "f", method="bucketed")
    w = (Window.partitionBy("tin").orderBy("d", "uid")
         .rowsBetween(0, Window.unboundedFollowing))
    ref = df.withColumn("f", F.first("extra", ignorenulls=True).over(w))
    u = other.unionByName(filled.select(*other.columns))
    got_rows = rows(u.filter(F.col("uid").isNotNull()).exceptAll(other), "uid", "f")
    assert got_rows == rows(ref, "uid", "f")
    vals = df.select("tin", F.col("day").cast("double").alias("v"))
    r = scan.value_ranks(vals, ["tin"], "v", buckets=6)
    pad = r.limit(3).repartition(4)
    got = {(t, v): b for t, v, _, b, _ in pad.unionByName(r).exceptAll(pad).collect()}
    pdf = vals.toPandas()
    for (t, v), b in got.items():
        assert b == int((pdf[(pdf["tin"] == t)]["v"] < v).sum())


def test_grouped_ranks_do_not_depend_on_buckets(spark):
    from regpanel.operators import scan
    df = _random_snapshots(spark, n=2500, seed=21).select(
        "tin", "state", F.col("day").cast("double").alias("v"))
    a = scan.value_ranks(df, ["tin", "state"], "v", buckets=2)
    b = scan.value_ranks(df, ["tin", "state"], "v", buckets=1000)
    cols = ["tin", "state", "v", "_cnt", "_before"]
    assert rows(a, *cols) == rows(b, *cols)
