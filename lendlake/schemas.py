"""Column contracts of every table, from the raw sources to the monitoring metrics.

Raw columns are text, apart from the snapshot date, so that reading a source never
changes a value; the silver operators are the only place where text gets a type.
"""

from __future__ import annotations


KEY = ["Customer_ID", "snapshot_date"]
SNAPSHOT = "snapshot_date"

MONEY_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
INTEGER_COLUMNS = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
    "Interest_Rate",
]
RATIO_COLUMNS = ["Changed_Credit_Limit", "Credit_Utilization_Ratio"]
ENCODED_COLUMNS = ["Credit_History_Age", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]
ENGINEERED_COLUMNS = [
    "Num_Fin_Pdts",
    "Loans_per_Credit_Item",
    "Debt_to_Salary",
    "EMI_to_Salary",
    "Repayment_Ability",
    "Loan_Extent",
]
CLICK_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

# Ordinal codes are positions in these lists.
CREDIT_MIX_LEVELS = ["Bad", "Standard", "Good"]
PAYMENT_BEHAVIOUR_LEVELS = [
    "Low_spent_Small_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Large_value_payments",
    "High_spent_Small_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Large_value_payments",
]

LAGS = list(range(1, 7))
ENGAGEMENT_COLUMNS = [f"click_{i}m" for i in LAGS]
RISK_COLUMNS = [
    "Credit_History_Age",
    "Num_Fin_Pdts",
    "EMI_to_Salary",
    "Debt_to_Salary",
    "Repayment_Ability",
    "Loans_per_Credit_Item",
    "Loan_Extent",
    "Outstanding_Debt",
    "Interest_Rate",
    "Delay_from_due_date",
    "Changed_Credit_Limit",
]
MODEL_FEATURES = ENGAGEMENT_COLUMNS + RISK_COLUMNS

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
CLICK_TYPES = {**{c: "int" for c in CLICK_COLUMNS}, "Customer_ID": "string", "snapshot_date": "date"}
RISK_TYPES = {
    "Credit_History_Age": "int",
    "Num_Fin_Pdts": "int",
    "EMI_to_Salary": "double",
    "Debt_to_Salary": "double",
    "Repayment_Ability": "double",
    "Loans_per_Credit_Item": "double",
    "Loan_Extent": "int",
    "Outstanding_Debt": "double",
    "Interest_Rate": "int",
    "Delay_from_due_date": "int",
    "Changed_Credit_Limit": "double",
}


def ddl(types: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {t}" for name, t in types.items())


def raw_ddl(columns: list[str]) -> str:
    """Text for every column but the snapshot date, which is a date."""
    return ddl({c: "date" if c == SNAPSHOT else "string" for c in columns})


RAW_COLUMNS = {
    "loans": list(LOAN_TYPES),
    "clickstream": list(CLICK_TYPES),
    "attributes": ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"],
    "financials": ["Customer_ID", *MONEY_COLUMNS, *INTEGER_COLUMNS, *RATIO_COLUMNS, *ENCODED_COLUMNS, "snapshot_date"],
}

TABLES = {
    ("bronze", name): raw_ddl(columns) for name, columns in RAW_COLUMNS.items()
} | {
    ("silver", "loans"): ddl(
        {**LOAN_TYPES, "mob": "int", "installments_missed": "int", "first_missed_date": "date", "dpd": "int"}
    ),
    ("silver", "clickstream"): ddl(CLICK_TYPES),
    ("silver", "attributes"): ddl(
        {"Customer_ID": "string", "Name": "string", "Age": "int", "SSN": "string", "Occupation": "string", "snapshot_date": "date"}
    ),
    ("silver", "financials"): ddl(
        {
            "Customer_ID": "string",
            **{c: "double" for c in MONEY_COLUMNS},
            **{c: "int" for c in INTEGER_COLUMNS},
            **{c: "double" for c in RATIO_COLUMNS},
            "Credit_History_Age": "int",
            "Credit_Mix": "int",
            "Payment_of_Min_Amount": "boolean",
            "Payment_Behaviour": "int",
            "Num_Fin_Pdts": "int",
            "Loans_per_Credit_Item": "double",
            "Debt_to_Salary": "double",
            "EMI_to_Salary": "double",
            "Repayment_Ability": "double",
            "Loan_Extent": "int",
            "snapshot_date": "date",
        }
    ),
    ("gold", "label_store"): "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date",
    ("gold", "engagement"): ddl(
        {"Customer_ID": "string", "snapshot_date": "date", **{c: "int" for c in ENGAGEMENT_COLUMNS}}
    ),
    ("gold", "risk"): ddl({"Customer_ID": "string", "snapshot_date": "date", **RISK_TYPES}),
    ("gold", "model_table"): ddl(
        {
            "Customer_ID": "string",
            "snapshot_date": "date",
            "loan_id": "string",
            "label": "int",
            "label_def": "string",
            **{c: "int" for c in ENGAGEMENT_COLUMNS},
            **RISK_TYPES,
        }
    ),
    ("gold", "splits"): ddl(
        {
            "Customer_ID": "string",
            "snapshot_date": "date",
            "loan_id": "string",
            "label": "int",
            "label_def": "string",
            **{c: "int" for c in ENGAGEMENT_COLUMNS},
            **RISK_TYPES,
            "split": "string",
        }
    ),
    ("gold", "predictions"): (
        "loan_id string, snapshot_date date, label int, probability double, prediction double, split string, model_name string, run_date date"
    ),
    ("gold", "score_counts"): (
        "score double, bads bigint, goods bigint, snapshot_date date, model_name string, run_date date, split string"
    ),
    ("gold", "model_manifest"): (
        "model_name string, model_dir string, run_date date, split string, auc double, preds_path string"
    ),
    ("bronze", "rejected_lines"): "source_table string, file string, reason string, line string",
    ("meta", "run_counts"): (
        "layer string, table_name string, rows_in bigint, undated bigint, repeated_rows bigint, rows_out bigint"
    ),
    ("gold", "monitoring"): (
        "snapshot_date date, test_auc double, model_name string, run_date date, split string, start_date date, end_date date"
    ),
}
