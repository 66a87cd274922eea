"""Areas against brute force over all pairs and against Spark's evaluator; bad-rate curves."""

import math
import random
from datetime import date

import pytest
from lendlake.operators import metrics
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

ROWS = "g string, y int, s double"


def brute_area(rows):
    bad = [s for _, y, s in rows if y == 1 and s is not None]
    good = [s for _, y, s in rows if y == 0 and s is not None]
    if not bad or not good:
        return None
    won = sum((b > g) + (b == g) / 2 for b in bad for g in good)
    return won / (len(bad) * len(good))


SCORES = {
    "ties": lambda rng: rng.choice([0.1, 0.2, 0.9]),
    "shares": lambda rng: rng.random(),
    "near one": lambda rng: 1 - rng.random() * 1e-12,
    "signed": lambda rng: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
    "edges": lambda rng: rng.choice([0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, 1.7e308, 1.0, 2.0, 4.0]),
    "counts": lambda rng: float(rng.randrange(20000)),
}


@pytest.mark.parametrize("kind", list(SCORES))
def test_area_matches_brute_force(spark, kind):
    rng = random.Random(kind)
    rows = [(rng.choice(["a", "b"]), rng.randrange(2), SCORES[kind](rng)) for _ in range(600)]
    rows += [("one class", 1, 0.3), ("missing", None, 0.5), ("missing", 1, None), ("missing", 1, 0.2), ("missing", 0, 0.1)]
    out = metrics.auc(spark.createDataFrame(rows, ROWS), "y", "s", ["g"])
    areas = {r.g: r.auc for r in out.collect()}
    assert set(areas) == {"a", "b", "one class", "missing"}
    assert areas["one class"] is None
    assert areas["missing"] == 1.0
    for group in "ab":
        assert areas[group] == pytest.approx(brute_area([r for r in rows if r[0] == group]), abs=1e-12)


def test_area_with_ties_and_without_groups(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.2), ("a", 1, 0.2), ("a", 0, 0.1)]
    assert metrics.auc(spark.createDataFrame(rows, ROWS), "y", "s").first().auc == 0.875


def test_area_equals_the_evaluator(spark):
    rng = random.Random(3)
    rows = [("a", rng.randrange(2), rng.randrange(40) / 40) for _ in range(500)]
    df = spark.createDataFrame(rows, ROWS).withColumn("y", F.col("y").cast("double"))
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    assert metrics.auc(df, "y", "s").first().auc == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_order_key_rises_with_the_score(spark):
    rng = random.Random(5)
    values = sorted({rng.choice([-1, 1]) * 2 ** rng.uniform(-1070, 1020) for _ in range(5000)} | {0.0, 1.0, 2.0, 0.5})
    df = spark.createDataFrame([(v,) for v in values], "s double")
    keys = [r[1] for r in df.select("s", metrics.order_key(F.col("s"))).orderBy("s").collect()]
    assert keys == sorted(keys)
    assert len(set(keys)) > 4900


def test_area_never_sorts_a_whole_group(spark):
    """One group with all rows still falls into many nodes of the second level."""
    df = spark.range(200_000).select((F.col("id") % 2).alias("y"), F.rand(1).alias("s"))
    key = metrics.order_key(F.col("s"))
    nodes = df.groupBy(F.shiftright(key, metrics.FINE_BITS)).count().agg(F.max("count")).first()[0]
    assert nodes < 1000
    assert metrics.auc(df, "y", "s").first().auc == pytest.approx(0.5, abs=0.01)


def test_areas_by_snapshot(spark):
    rows = [(date(2023, m, 1), y, s) for m in (1, 2, 3) for y, s in [(1, 0.9), (0, 0.1), (m % 2, 0.5)]]
    df = spark.createDataFrame(rows, "snapshot_date date, label int, probability double")
    out = metrics.auc_by_snapshot(df, "2023-02-01", "2023-03-01").collect()
    assert [r.snapshot_date for r in out] == [date(2023, 2, 1), date(2023, 3, 1)]
    assert metrics.auc_by_snapshot(df, "2030-01-01", "2030-03-01").count() == 0


def test_bad_rate_and_final_instalment(spark):
    rows = [("2023-05-01", 1, 0), ("2023-05-01", 1, 45), ("2023-05-01", 10, None), ("2024-01-01", 1, 90)]
    df = spark.createDataFrame(rows, "loan_start_date string, mob int, dpd int").selectExpr(
        "cast(loan_start_date as date) as loan_start_date", "mob", "dpd", "mob as installment_num"
    )
    curve = [tuple(r) for r in metrics.bad_rate_by_mob(df, "2024-01-01").collect()]
    assert curve == [(1, 0.5, 2), (10, 0.0, 1)]
    assert metrics.actual_bads(df, "2024-01-01").count() == 1


def test_counts_of_any_groups_merge_to_the_area_of_their_rows(spark):
    """Ties across groups, groups of one class, missing labels and scores, both zeros, infinities and NaN."""
    rng = random.Random(3)
    special = [0.0, -0.0, float("inf"), float("-inf"), float("nan"), 1e-300, None]
    rows = [(rng.choice("abcd"), rng.randrange(6), rng.choice([0, 1, None]), rng.choice([*special, *[rng.randrange(40) / 7 for _ in range(20)]])) for _ in range(3000)]
    rows += [("e", 1, 1, 0.5), ("f", 1, None, 0.5)]
    df = spark.createDataFrame(rows, "split string, month int, label int, p double").repartition(5)
    counts = metrics.score_counts(df, "label", "p", ["split", "month"])
    for by in ([], ["split"], ["month"], ["split", "month"]):
        merged = sorted(map(tuple, metrics.auc_of_counts(counts, by).collect()), key=repr)
        plain = sorted(map(tuple, metrics.auc(df, "label", "p", by).collect()), key=repr)
        assert merged == plain and len(merged) >= 1
    assert metrics.auc_of_counts(counts.limit(0), ["split"]).isEmpty()
