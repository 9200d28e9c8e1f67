"""Steps whose cost must not grow faster than the input: plans and partitions."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabprep.functions import clean as C
from tabprep.operators import partitioning as P
from tabprep.operators import prep as M
from tabprep.plans import leafwise as LW


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "label double, x array<double>").withColumn("features", array_to_vector("x"))


def test_cleaned_values_are_written_out_once(spark):
    rows = spark.createDataFrame([(" $1,200k ",), ("error_1",), (None,), (" None ",)], "x string")
    number = rows.select(C.clean_numeric(C.trim_to_null("x")).alias("v"))
    assert plan(number).count("regexp_replace(") <= 1
    assert plan(rows.select(C.clean_category("x").alias("v"))).count("trim(") == 1
    assert [r.v for r in number.collect()] == [1_200_000.0, None, None, None]


def test_class_weights_leave_rows_where_they_are(spark):
    rows = P.materialize(spark.createDataFrame([(float(i % 5 == 0), i) for i in range(100)], "label double, i int"))
    weighted = M.class_weights(rows, "label", "w")
    assert "BroadcastHashJoin" in plan(weighted, "executedPlan") and "SortMergeJoin" not in plan(weighted, "executedPlan")
    assert {(r.label, round(r.w, 6)) for r in weighted.collect()} == {(1.0, 2.5), (0.0, 0.625)}


def test_fit_partitions_follow_rows(spark):
    rows = P.materialize(spark.range(1000).coalesce(1))
    spread = P.spread_rows(rows, rows=100)
    assert spread.rdd.getNumPartitions() == 10 and spread.count() == 1000
    assert max(spread.rdd.glom().map(len).collect()) <= 120
    assert P.spread_rows(rows).rdd.getNumPartitions() == rows.rdd.getNumPartitions()


def test_sweep_spreads_its_rows_once(spark, monkeypatch):
    from tabprep.plans import train as TR
    from tabprep.registry import curated
    rows = curated(spark, "/root/testdata/sf0.001")
    configs = [TR.ModelConfig("lr", "LogisticRegression", {"maxIter": 3}), TR.ModelConfig("dt", "DecisionTreeClassifier", {"maxDepth": 3}),
               TR.JOB_CONFIGS["compact_dt"]]
    plain = TR.run_sweep(rows, configs)
    calls, held = [], []

    class Seen(type(rows)):
        def persist(self, *a):
            held.append(self)
            return super().persist(*a)

    def spread(df):
        n = df.rdd.getNumPartitions()
        out = P.spread_rows(df, rows=50)
        calls.append(out.rdd.getNumPartitions() > n)
        return Seen(out._jdf, out.sparkSession) if calls[-1] else out

    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    monkeypatch.setattr(TR, "spread_rows", spread)
    res = TR.run_sweep(rows, configs)
    assert calls == [True, True]  # two preparations, three fits
    assert len(held) == 1 and not held[0].is_cached and set(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    counts = ["run_name", *TR.COUNT_FIELDS]
    assert res.runs.select(counts).sort("run_name").collect() == plain.runs.select(counts).sort("run_name").collect()


def test_request_ingest_reads_its_source_once(spark):
    from tabprep.registry import QUERIES, raw
    sf = "/root/testdata/sf0.001"
    assert plan(QUERIES["request_ingest"](spark, sf)).count("Relation [o_orderkey") == plan(raw(spark, sf)).count("Relation [o_orderkey")


def test_histogram_rows_follow_the_model(spark):
    """A pass sends one row a cell and task into the shuffle, not one a value."""
    rows = vectors(spark, [(float(i % 2), [float(i % 4), float(i % 7 == 0)]) for i in range(5000)])
    edges = LW.fit_edges(rows)
    binned, layout = LW.binned(rows, edges)
    found = LW.histograms(binned.withColumn("score", F.lit(0.0)), {}, [1], layout)
    assert "Generate" not in plan(found) and "MapInArrow" in plan(found)
    assert layout.sizes == [4, 2] and found.where("slot = -1").first()["rows"] == 5000
    bad = vectors(spark, [(None, [1.0]), (1.0, [2.0])])
    with pytest.raises(Exception, match="null"):
        LW.fit(bad, LW.Params(rounds=1))
