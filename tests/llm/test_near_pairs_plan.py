"""Fingerprints of a few MB are not broadcast after they were exploded."""

from pressgauge.llm import simhash


def test_near_pairs_are_not_broadcast(spark, tmp_path):
    rows = [(i, i << 17) for i in range(40)] + [(100, (3 << 17) | 5)]
    spark.createDataFrame(rows, "least bigint, fp bigint").write.parquet(f"{tmp_path}/prints")
    prints = spark.read.parquet(f"{tmp_path}/prints")
    pairs = simhash.near_pairs(prints)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    fps = [fp for _, fp in rows]
    want = {frozenset((a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 4}
    assert {frozenset(r) for r in pairs.collect()} == want
