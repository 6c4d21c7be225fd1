import pytest
from pyspark.sql import functions as F

from reelspark.functions.taxonomy import WAREHOUSE
from reelspark.operators import near_duplicates, validation
from reelspark.sources import fixtures


@pytest.mark.parametrize("n", [40, 120])
def test_the_funnel_of_fixtures(spark, n):
    """Every stage's count is the expected one, and every kind goes where it is meant to."""
    made = fixtures.fixtures(spark, n).cache()
    want = fixtures.expected(n)
    assert {r.kind: r["count"] for r in made.groupBy("kind").count().collect()} == fixtures.counts(n)
    judged = validation.checked(made.select("ord", "raw"), WAREHOUSE)
    good = judged.filter("ok").select("ord", "record").join(made.drop("raw"), "ord")
    reasons = {(r.kind, x.split(":")[0]) for r in judged.join(made, "ord").select("kind", "reasons").collect() for x in r.reasons}
    assert reasons == {("slow", "fps_too_low"), ("partial_actions", "incomplete_actions"), ("other_scenario", "scenario_mismatch"), ("no_pov", "missing_field")}
    there = good.filter("present")
    problems = validation.probe_problems(F.col("record.end_ms") - F.col("record.start_ms"), F.col("record.fps"), F.col("probe"), WAREHOUSE)
    probed = there.withColumn("problems", problems)
    assert {(r.kind, x.split(":")[0]) for r in probed.collect() for x in r.problems} >= {("corrupt", "probe_failed"), ("short_file", "duration_mismatch")}
    valid = probed.filter(F.size("problems") == 0)
    won = near_duplicates.winners(near_duplicates.clusters(valid.select("ord", "sig"), 8.0, 5).join(valid.select("ord", F.col("probe.height").alias("quality")), "ord"))
    found = [made.count(), good.count(), there.count(), valid.count(), won.filter("keep").count()]
    assert found == [want[k] for k in ("fetched", "schema_valid", "file_present", "probe_valid", "unique")]
    assert [r.video_uri for r in made.orderBy("ord").limit(5).collect()] != sorted(r.video_uri for r in made.orderBy("ord").limit(5).collect())


def test_fixtures_are_told_by_the_seed(spark):
    one, two, other = (fixtures.fixtures(spark, 40, seed).orderBy("ord").collect() for seed in (1, 1, 2))
    assert one == two and [r.raw for r in one] != [r.raw for r in other]
    assert fixtures.expected(120) == {"fetched": 118, "schema_valid": 101, "file_present": 99, "probe_valid": 90, "unique": 74, "training_ready": 74}
