"""Hot keys: the split paths must give what the plain windows give."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtables.operators import flow, naming, refs
from flowtables.operators.spread import dealt_if_many, hot_keys, lookup, numbered, paged_lists, running
from flowtables.plans.lifecycle import state_plan, teardown_plan
from flowtables.suite.rules import part_criteria


def skewed(spark, rows=3000, seed=1):
    """A third of the rows in one key, a null key, equal timestamps within keys."""
    pick = random.Random(seed)
    data = []
    for i in range(rows):
        key = pick.choice(["hot", "hot", None, "a", "b", f"k{i % 50}"])
        data.append((key, pick.randrange(20), i, float(pick.randrange(100)) if i % 7 else None))
    return spark.createDataFrame(data, "k string, t int, id int, v double").repartition(5)


def bag(df):
    return sorted(map(repr, df.collect()))


def test_running_split_equals_plain(spark):
    df = skewed(spark)
    sums = {"n": F.lit(1).cast("bigint"), "s": F.col("v")}
    plain = running(df, ["k"], ["t", "id"], sums, hot_rows=None)
    for limit in (40, 200, 700):
        assert hot_keys(df, ["k"], limit) is not None
        assert bag(running(df, ["k"], ["t", "id"], sums, hot_rows=limit)) == bag(plain)


def test_running_split_descending(spark):
    df = skewed(spark)
    order = [F.col("t").desc(), F.col("id")]
    window = Window.partitionBy("k").orderBy(*order)
    plain = df.withColumn("n", F.row_number().over(window).cast("bigint"))
    assert bag(numbered(df, ["k"], order, "n", hot_rows=100)) == bag(plain)


def test_no_hot_key_means_no_split(spark):
    assert hot_keys(skewed(spark), ["k"], 10_000) is None


def test_pages_hold_everything_in_order(spark):
    df = skewed(spark)
    for limit in (None, 100):
        pages = paged_lists(df, ["k"], ["t", "id"], F.col("id"), "ids", page_rows=64, hot_rows=limit)
        got = {}
        for row in sorted(pages.collect(), key=lambda r: r["page"]):
            assert len(row["ids"]) <= 64
            got.setdefault(row["k"], []).extend(row["ids"])
        wanted = {}
        for row in sorted(df.collect(), key=lambda r: (r["t"], r["id"])):
            wanted.setdefault(row["k"], []).append(row["id"])
        assert got == wanted


def test_lookup_keeps_null_keys(spark):
    df = skewed(spark)
    table = spark.createDataFrame([("hot", 1), ("a", 2)], "name string, number int")
    got = lookup(df, table, [F.col("k")], ["name"], ["number"])
    assert got.columns == [*df.columns, "number"]
    assert got.count() == df.count()
    wanted = {"hot": 1, "a": 2}
    assert all(r["number"] == wanted.get(r["k"]) for r in got.collect())


def test_batches_and_state_split(spark):
    df = skewed(spark).withColumn("size", F.coalesce(F.col("v").cast("int"), F.lit(3)))
    for limits in ({"count": 7}, {"size": ("size", 150)}):
        plain = flow.assign_batches(df, ["k"], ["t", "id"], hot_rows=None, **limits)
        split = flow.assign_batches(df, ["k"], ["t", "id"], hot_rows=90, **limits)
        assert bag(plain) == bag(split)
    plain = flow.running_state(df, ["k"], ["t", "id"], F.col("v"), 5.0, hot_rows=None)
    split = flow.running_state(df, ["k"], ["t", "id"], F.col("v"), 5.0, hot_rows=90)
    assert bag(plain) == bag(split)


def test_names_split(spark):
    rows = skewed(spark).select(
        F.lit("s").alias("scope"), F.concat(F.lit("p."), F.coalesce("k", F.lit("z"))).alias("type"), "t", "id"
    )
    plain = naming.canonical_names(rows, ["scope"], "type", ["t"], ["id"], hot_rows=None)
    split = naming.canonical_names(rows, ["scope"], "type", ["t"], ["id"], hot_rows=5)
    assert bag(plain) == bag(split)


def test_attach_inputs_pages(spark):
    edges = skewed(spark).where("k IS NOT NULL").select(F.col("k").alias("dest"), "id")
    components = edges.select(F.col("dest").alias("id")).distinct().unionByName(
        spark.createDataFrame([("alone",)], "id string")
    )
    attached = refs.attach_inputs(
        components, edges, ["id"], ["dest"], ["id"], F.col("id"), page_rows=50, hot_rows=80
    )
    rows = attached.collect()
    assert sum(len(r["inputs"]) for r in rows) == edges.count()
    assert [(r["page"], r["inputs"]) for r in rows if r["id"] == "alone"] == [(0, [])]
    flat = refs.flat_inputs(components, edges.withColumnRenamed("id", "edge"), ["id"], ["dest"])
    assert flat.count() == edges.count() + 1


def test_state_plan_split(spark):
    components = skewed(spark).select(
        F.coalesce("k", F.lit("z")).alias("w"),
        F.col("id").cast("string").alias("id"),
        F.when(F.col("t") < 10, "PROCESSOR").otherwise("CONTROLLER").alias("kind"),
        F.when(F.col("t") < 5, "DISABLED").alias("status"),
        F.array(F.col("t").cast("bigint")).alias("group_ords"),
        F.col("id").cast("bigint").alias("ord"),
    )
    plain = state_plan(components, ["w"], "enabled", hot_rows=None)
    assert bag(plain) == bag(state_plan(components, ["w"], "enabled", hot_rows=100))


def test_balance(spark):
    df = skewed(spark).where("k IS NOT NULL")
    together = flow.balance(df, 6, "k").withColumn("p", F.spark_partition_id())
    assert together.groupBy("k").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
    spread = flow.balance(df, 6, "k", parts=4).withColumn("p", F.spark_partition_id())
    parts = {r["k"]: r["n"] for r in spread.groupBy("k").agg(F.count_distinct("p").alias("n")).collect()}
    assert parts["hot"] > 1
    assert spread.count() == df.count()


def test_top_k_small_large_and_full(spark):
    df = skewed(spark)
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    full = flow.prioritized(df, ["k"], order)
    assert full.count() == df.count()
    limit = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    for k in (1, 30, limit + 1):
        assert bag(flow.prioritized(df, ["k"], order, k)) == bag(full.where(F.col("place") <= k))


def test_lookup_spreads_rows_without_a_key(spark):
    """Also against a side that is grouped by the key, where no skew join splits them."""
    left = spark.range(4000).select("id", F.when(F.col("id") < 0, "x").alias("k"))
    right = spark.range(100).groupBy(F.col("id").cast("string").alias("k2")).agg(F.count("id").alias("n"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = lookup(left, right, [F.col("k")], ["k2"], ["n"])
        # the number found is read, or the join would be left out
        sums = [F.count("id").alias("rows"), F.count("n").alias("found")]
        parts = found.groupBy(F.spark_partition_id().alias("part")).agg(*sums).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(p["rows"] for p in parts) == 4000 and max(p["rows"] for p in parts) < 1000
    assert not any(p["found"] for p in parts)


def test_rows_of_one_row_group_are_dealt_if_many(spark):
    tasks = lambda df: df.select(F.spark_partition_id()).distinct().count()
    rows = spark.range(0, 500, 1, 1)
    assert tasks(dealt_if_many(rows, 500)) == 1
    assert tasks(dealt_if_many(rows, 499)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bag(dealt_if_many(rows, 10)) == bag(rows)
    # 20,000 parts in one row group: as many tasks make and read their XML as the session shuffles to
    parts = part_criteria(spark, "/root/testdata/sf0.1")
    assert tasks(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts.count() == 20000


def test_plans_work_rows_out_once_for_hot_scopes(spark):
    worked = spark.sparkContext.accumulator(0)

    def noted(i):
        worked.add(1)
        return i % 3

    scope = F.udf(noted, "int").asNondeterministic()
    components = spark.range(0, 900, 1, 4).select(
        scope("id").alias("w"),
        "id",
        F.lit("PROCESSOR").alias("kind"),
        F.array(F.lit(1).cast("bigint")).alias("group_ords"),
        F.col("id").alias("ord"),
    )
    placed = teardown_plan(components, ["w"], hot_rows=100).collect()
    # counted (twice, as a checkpoint is) and stored
    assert worked.value <= 3 * 900
    assert {(r["w"], r["id"], r["position"]) for r in placed} == {(i % 3, i, i // 3 + 1) for i in range(900)}
