"""Property-based checks of the two scale rewrites against their plain forms."""

from fixtures import plain_rank
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vehicle_metrics.operators.ranking import global_rank
from vehicle_metrics.sources.ingest import dedupe_by_key

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.none(), st.integers(-3, 3).map(lambda i: i / 2)), min_size=1, max_size=60)


@SETTINGS
@given(vals=values, ascending=st.booleans(), per_bucket=st.sampled_from([1, 2, 5]))
def test_rank_property(spark, vals, ascending, per_bucket):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    got = sorted(tuple(r) for r in global_rank(df, "x", "r", ascending=ascending, values_per_bucket=per_bucket).select("id", "r").collect())
    exp = sorted(tuple(r) for r in plain_rank(df, "x", "r", ascending=ascending).select("id", "r").collect())
    assert got == exp


rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from(["x", "y"]))), min_size=1, max_size=30)


@SETTINGS
@given(data=rows)
def test_dedupe_property(spark, data):
    df = spark.createDataFrame(data, "k string, t int, s string")
    got = sorted(tuple(r) for r in dedupe_by_key(df, "k", ["t"]).collect())
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), F.col("s").asc_nulls_first())
    exp = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect())
    assert got == exp
