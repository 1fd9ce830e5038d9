from pyspark.sql import functions as F

from plinth.llm.store import join_small, materialise

AUTO = "spark.sql.autoBroadcastJoinThreshold"


def broadcasts(spark):
    """Names of the last execution's operators that broadcast."""
    store = spark._jsparkSession.sharedState().statusStore()
    nodes = store.planGraph(store.executionsList().last().executionId()).allNodes()
    return [name for i in range(nodes.size()) if (name := nodes.apply(i).name()).startswith("Broadcast")]


def test_uncounted_sides_are_not_broadcast(spark):
    # a few bytes a group in the estimate, and as many groups as rows
    named = materialise(spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"), (F.col("id") * 7).alias("component")))
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    before = spark.conf.get(AUTO)
    assert materialise(named.join(least, "component")).count() == 200_000
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    materialise(named.join(least, "component"))
    assert broadcasts(spark) == []
    assert spark.conf.get(AUTO) == before
    materialise(named.join(F.broadcast(least.filter("least < 10")), "component"))
    assert broadcasts(spark) != []


def test_salted_copies_are_not_broadcast(spark):
    small = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    plan = join_small(spark.range(100).select(F.col("id").alias("k")), small, ["k"], F.col("k"), "left", small_enough=False)
    assert plan.count() == 100
    assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
