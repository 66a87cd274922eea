"""Engagement lags, the lookup join and its behaviour on hot keys, against brute force."""

import random
from datetime import date

import pytest
from lendlake import schemas as S
from lendlake.functions.dates import month_calendar, month_list, shift_months, trailing_window
from lendlake.operators import gold, lookup
from pyspark.sql import functions as F

CLICKS = "Customer_ID string, snapshot_date date, fe_1 int"
MONTHS = month_list("2023-01-01", "2024-12-01")


def brute_engagement(rows, snapshots):
    found = {}
    for customer, month, value in rows:
        if value is not None or (customer, month) not in found:
            found[customer, month] = max(v for v in (value, found.get((customer, month)), -1) if v is not None)
    found = {key: None if value == -1 else value for key, value in found.items()}
    out = set()
    for snapshot in snapshots:
        past = [shift_months(snapshot, -lag) for lag in S.LAGS]
        for customer in {c for c, m in found if m in past}:
            out.add((customer, snapshot, *[found.get((customer, m)) for m in past]))
    return out


def test_engagement_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (f"C{rng.randrange(30)}", rng.choice(MONTHS), rng.choice([None, *range(50)]))
        for _ in range(400)
    ]
    rows += [("hot", rng.choice(MONTHS), rng.randrange(100)) for _ in range(300)]
    snapshots = MONTHS[2:20]
    calendar = month_calendar(spark, snapshots[0], snapshots[-1])
    out = gold.engagement(spark.createDataFrame(rows, CLICKS), calendar)
    assert out.columns == [*S.KEY, *S.ENGAGEMENT_COLUMNS]
    result = [tuple(r) for r in out.collect()]
    assert len(result) == len(set(result))
    assert set(result) == brute_engagement(rows, snapshots)


def test_engagement_of_one_customer(spark):
    df = spark.createDataFrame([("C1", date(2023, 1, 1), 5)], CLICKS)
    out = {r.snapshot_date: tuple(r)[2:] for r in gold.engagement(df).collect()}
    assert len(out) == 6
    assert out[date(2023, 4, 1)] == (None, None, 5, None, None, None)


def test_engagement_counts_calendar_months(spark):
    """Mid-month, month-end and undated clicks and snapshots; two snapshots of one month."""
    days = [date(2023, 1, 31), date(2023, 1, 2), date(2023, 2, 15), date(2023, 4, 30), None]
    rows = [(c, day, i + 10 * j) for i, c in enumerate(["C1", "C2", None]) for j, day in enumerate(days)]
    snapshots = [date(2023, 3, 31), date(2023, 3, 1), date(2023, 7, 15), date(2024, 1, 1), None]
    calendar = spark.createDataFrame([(day,) for day in [*snapshots, snapshots[0]]], "snapshot_date date")
    out = [tuple(r) for r in gold.engagement(spark.createDataFrame(rows, CLICKS), calendar).collect()]
    months = [(c, day.replace(day=1), value) for c, day, value in rows if day]
    expected = {
        (row[0], day, *row[2:]) for day in snapshots if day for row in brute_engagement(months, [day.replace(day=1)])
    }
    assert len(out) == len(expected) == 9
    assert set(out) == expected


def test_engagement_of_another_feature(spark):
    df = spark.createDataFrame([("C1", date(2023, 1, 1), 5)], CLICKS).withColumnRenamed("fe_1", "fe_9")
    assert gold.engagement(df, feature="fe_9").where("click_1m = 5").count() == 1


LABELS = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all labels at one key, others without a key, and repeated risk rows."""
    month = date(2023, 6, 1)
    labels = [(f"L{i}", "hot", i % 2, "d", month) for i in range(1000)]
    labels += [(f"M{i}", f"C{i}", i % 2, "d", month) for i in range(1500)]
    labels += [(f"N{i}", None, 0, "d", month) for i in range(500)]
    customers = ["hot", *[f"C{i}" for i in range(0, 1500, 2)]]
    engaged = [(c, month, *range(n, n + 6)) for n, c in enumerate(customers)]
    risk = [(c, month, *[n + k for k in range(11)]) for n, c in enumerate(customers) for _ in range(1 + n % 3)]
    engaged_ddl = S.TABLES["gold", "engagement"]
    risk_ddl = ", ".join(["Customer_ID string", "snapshot_date date", *[f"{c} int" for c in S.RISK_COLUMNS]])
    return (
        spark.createDataFrame(labels, LABELS),
        spark.createDataFrame(engaged, engaged_ddl),
        spark.createDataFrame(risk, risk_ddl),
    )


@pytest.mark.parametrize("rows_per_slice", [100, 1_000_000])
def test_model_table_equals_plain_joins(skewed, rows_per_slice):
    labels, engaged, risk = skewed
    out = gold.model_table(labels, engaged, risk, rows_per_slice)
    plain = labels.join(engaged, S.KEY, "left").join(risk.distinct(), S.KEY, "left")
    assert out.columns == plain.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, plain.collect()))
    assert out.count() == labels.count()


def test_hot_keys_are_cut_into_slices(skewed):
    labels, _, _ = skewed
    hot = lookup.hot_keys(labels, S.KEY, 100)
    assert {(r.Customer_ID, r._slices) for r in hot.collect()} == {("hot", 10), (None, 5)}
    placed = lookup._with_slices(labels, hot, S.KEY)
    place = F.pmod(F.xxhash64("loan_id"), F.col("_slices"))
    sizes = placed.groupBy(*S.KEY, place).count().agg(F.max("count")).first()[0]
    assert sizes < 200


def test_repeated_feature_rows_stay_whole(spark):
    rows = [("C1", n, -n) for n in range(50)]
    df = spark.createDataFrame(rows, "k string, a int, b int").repartition(7)
    first, second = (lookup.one_row_per_key(d, ["k"]).first() for d in (df, df.repartition(3)))
    assert first == second
    assert (first.k, first.a, first.b) in rows


def test_calendar(spark):
    dates = [r[0] for r in month_calendar(spark, "2023-01-15", "2024-12-01").orderBy(S.SNAPSHOT).collect()]
    assert dates == MONTHS
    assert len(dates) == 24
    assert dates[0] == date(2023, 1, 1)
    assert dates[-1] == date(2024, 12, 1)
    assert month_list("2023-05-01", "2023-04-01") == []
    assert trailing_window("2023-03-01") == (date(2023, 1, 30), date(2023, 3, 1))
