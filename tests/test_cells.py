"""Edge rows of every cleaning rule: one dirty value in, one expected value out."""

from datetime import date

import pytest
from lendlake import schemas as S
from lendlake.functions import columns as C
from lendlake.operators import gold, silver

D = date.fromisoformat


def cells(spark, values, kind, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in df.select("i", rule("x").alias("y")).orderBy("i").collect()]


CASES = {
    "int": (lambda c: C.typed(c, "int"), ["3.7", "3.0", "-3.7", " 12 ", "", "x", None, "99999999999"], [3, 3, -3, 12, None, None, None, None]),
    "float": (lambda c: C.typed(c, "float"), ["1.5", "", "a"], [1.5, None, None]),
    "date": (lambda c: C.typed(c, "date"), ["2023-01-01", "nope"], [D("2023-01-01"), None]),
    "name": (C.person_name, [" J0hn O'Neil-Smith# ", None, "Ann\tLee"], ["Jhn O'Neil-Smith", None, "AnnLee"]),
    "digits": (C.digits_int, ["4_", "-1", "", None, "99999999999"], [4, 1, None, None, None]),
    "money": (
        C.money,
        ["34847.8456_", "-10.5", "__10000__", "", "1.2.3", "__-333333333333333333333333333__"],
        [34847.846, 10.5, 10000.0, None, None, 333333333333333333333333333.0],
    ),
    "ratio": (C.digits_double, ["_", "-2.15", "3.14159"], [None, 2.15, 3.14159]),
    "credit age": (
        C.months_from_text,
        ["10 Years and 9 Months", "NA", "x 1 Years and 2 Months", None, "1 Years and 2 Months left", "999999999999 Years and 1 Months"],
        [129, None, None, None, 14, None],
    ),
    "credit mix": (lambda c: C.ordinal(c, S.CREDIT_MIX_LEVELS), ["Bad", "Standard", "Good", "_", None], [0, 1, 2, None, None]),
    "minimum": (C.yes_no, ["Yes", "No", "NM", None], [True, False, None, None]),
    "behaviour": (
        lambda c: C.ordinal(c, S.PAYMENT_BEHAVIOUR_LEVELS),
        ["Low_spent_Small_value_payments", "Low_spent_Large_value_payments", "High_spent_Small_value_payments", "High_spent_Large_value_payments", "!@9#%8"],
        [0, 2, 3, 5, None],
    ),
    "ssn": (
        lambda c: C.matching(c, silver.SSN_PATTERN),
        ["123-45-6789", "123456789", "#F%$D@*&8", "x123-45-6789", None],
        ["123-45-6789", None, None, None, None],
    ),
}


@pytest.mark.parametrize("case", list(CASES))
def test_text_rules(spark, case):
    rule, values, expected = CASES[case]
    assert cells(spark, values, "string", rule) == expected


def test_number_rules(spark):
    assert cells(spark, [-3, None, 7], "int", C.clamp_low) == [0, None, 7]
    assert cells(spark, [5797, 34, None], "int", lambda c: C.cap(c, 34)) == [34, 34, None]


LOAN = {
    "loan_id": "L1", "Customer_ID": "C1", "loan_start_date": "2022-09-01", "tenure": "10", "installment_num": "6",
    "loan_amt": "1000", "due_amt": "100", "paid_amt": "0", "overdue_amt": "0", "balance": "1", "snapshot_date": "2023-03-01",
}


def silver_loan(spark, **change):
    row = LOAN | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    return silver.silver_loans(df)


@pytest.mark.parametrize(
    ("change", "missed", "first_missed", "dpd", "label"),
    [
        ({"overdue_amt": "250"}, 3, "2022-12-01", 90, 1),
        ({"overdue_amt": "0"}, 0, None, 0, 0),
        ({"overdue_amt": "50", "due_amt": "0"}, 0, None, None, 0),
        ({"overdue_amt": None}, 0, None, 0, 0),
        ({"overdue_amt": "100"}, 1, "2023-02-01", 28, 0),
        ({"overdue_amt": "100", "snapshot_date": "2023-05-01"}, 1, "2023-04-01", 30, 1),
        ({"overdue_amt": "100000", "due_amt": "0.0001"}, 1000000026, None, 738579, 1),
        ({"overdue_amt": "100000", "due_amt": "1e-7"}, 2**31 - 1, None, 738579, 1),
        ({"overdue_amt": "24264", "due_amt": "1"}, 24264, "0001-03-01", 738520, 1),
        ({"overdue_amt": "24265", "due_amt": "1"}, 24265, None, 738579, 1),
    ],
)
def test_days_past_due(spark, change, missed, first_missed, dpd, label):
    df = silver_loan(spark, **change)
    row = df.first()
    assert (row.mob, row.installments_missed, row.dpd) == (6, missed, dpd)
    assert row.first_missed_date == (D(first_missed) if first_missed else None)
    assert gold.default_labels(df).first().label == label


def test_missing_numbers_become_zero(spark):
    row = silver_loan(spark, overdue_amt=None, paid_amt=None, tenure=None, balance="bad", Customer_ID=None).first()
    assert (row.overdue_amt, row.paid_amt, row.tenure, row.balance, row.Customer_ID) == (0, 0, 0, 0, None)


def test_label_definition(spark):
    df = silver_loan(spark, overdue_amt="250", installment_num="4")
    assert gold.default_labels(df).count() == 0
    row = gold.default_labels(df, dpd=91, mob=4).first()
    assert (row.label, row.label_def) == (0, "91dpd_4mob")


def test_attributes(spark):
    rows = [("C1", age, "x", "1", job, D("2023-01-01"), "kept") for age, job in [
        ("23_", "_______"), ("-5", "Media_Manager"), ("-500", "Lawyer"), ("101", None), ("abc", "Doctor"),
    ]]
    columns = "Customer_ID string, Age string, Name string, SSN string, Occupation string, snapshot_date date, extra string"
    out = silver.silver_attributes(spark.createDataFrame(rows, columns)).collect()
    assert [r.Age for r in out] == [23, 5, None, None, None]
    assert [r.Occupation for r in out] == [None, "Media Manager", "Lawyer", None, "Doctor"]
    assert {r.extra for r in out} == {"kept"}


def financial_row(spark, **change):
    row = {c: None for c in S.RAW_COLUMNS["financials"]} | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    return silver.silver_financials(df).first()


def test_engineered_columns(spark):
    row = financial_row(spark, Num_Bank_Accounts="3", Num_Credit_Card="4_", Num_of_Loan="-2", Delay_from_due_date="-7")
    assert (row.Num_Fin_Pdts, row.Loans_per_Credit_Item, row.Loan_Extent) == (9, 0.25, 14)
    assert (row.Debt_to_Salary, row.EMI_to_Salary, row.Repayment_Ability) == (None, None, None)


def test_engineered_columns_use_the_limits(spark):
    row = financial_row(
        spark, Num_Bank_Accounts="1798", Num_Credit_Card="1499", Num_of_Loan="100", Interest_Rate="5797",
        Num_of_Delayed_Payment="4000", Num_Credit_Inquiries="1000", Delay_from_due_date="2000000000",
        Monthly_Inhand_Salary="99.0_", Total_EMI_per_month="-50", Outstanding_Debt="1000",
    )
    assert (row.Num_Bank_Accounts, row.Num_Credit_Card, row.Num_of_Loan, row.Interest_Rate) == (10, 10, 9, 34)
    assert (row.Num_of_Delayed_Payment, row.Num_Credit_Inquiries, row.Num_Fin_Pdts) == (47, 26, 29)
    assert (row.Debt_to_Salary, row.EMI_to_Salary, row.Repayment_Ability) == (10.0, 0.5, 49.0)
    assert row.Loan_Extent is None


def test_a_rule_stands_once_in_the_plan(spark):
    """Not once a column: methods of more than 8,000 bytes are never compiled."""
    raw = spark.createDataFrame([("1",) * len(S.RAW_COLUMNS["financials"])], S.RAW_COLUMNS["financials"])
    plan = silver.clean_financials(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 3
