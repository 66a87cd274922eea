"""Typing, cleaning and enrichment of the four sources, all months at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake import schemas as S
from lendlake.functions import columns as C

# Valid social security number, empty occupation, age range.
SSN_PATTERN = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
BLANK_OCCUPATION = "_______"
OCCUPATION_RENAMES = {"Media_Manager": "Media Manager"}
AGE_RANGE = (0, 100)

# Upper limits of the integer columns.
CAPS = {
    "Num_Bank_Accounts": 10,
    "Num_Credit_Card": 10,
    "Interest_Rate": 34,
    "Num_of_Loan": 9,
    "Num_of_Delayed_Payment": 47,
    "Num_Credit_Inquiries": 26,
}

INT_MAX = 2**31 - 1

ENGINEERED = {
    "Num_Fin_Pdts": "Num_Bank_Accounts + Num_Credit_Card + Num_of_Loan",
    "Loans_per_Credit_Item": "Num_of_Loan / (Num_Bank_Accounts + Num_Credit_Card + 1)",
    "Debt_to_Salary": "Outstanding_Debt / (Monthly_Inhand_Salary + 1)",
    "EMI_to_Salary": "Total_EMI_per_month / (Monthly_Inhand_Salary + 1)",
    "Repayment_Ability": "Monthly_Inhand_Salary - Total_EMI_per_month",
    "Loan_Extent": "try_multiply(Delay_from_due_date, Num_of_Loan)",
}


def enforce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns that have another type; other columns pass through."""
    present = dict(df.dtypes)
    return df.withColumns({name: C.typed(name, to) for name, to in types.items() if present[name] != to})


def days_past_due(df: DataFrame) -> DataFrame:
    """Months on book, instalments missed, first missed date and days past due.

    A missing amount counts as 0, and so does every other missing number of the row. Instalments stop at the integer range. When they
    reach back before the calendar's first year, there is no first missed date, and the days past due are all the calendar has.
    """
    owed = F.ceil(F.try_divide("overdue_amt", "due_amt"))
    missed = F.when(owed > INT_MAX, INT_MAX).otherwise(owed).try_cast("int")
    counted = df.withColumns({"mob": F.col("installment_num"), "installments_missed": missed}).fillna(0)
    first_missed = """if(installments_missed between 1 and 12 * (year(snapshot_date) - 1),
                         add_months(snapshot_date, -installments_missed), null)"""
    since = "if(installments_missed > 0, coalesce(first_missed_date, date'0001-01-01'), null)"
    dated = counted.withColumn("first_missed_date", F.expr(first_missed))
    return dated.withColumn("dpd", F.expr(f"if(overdue_amt > 0, datediff(snapshot_date, {since}), 0)"))


def silver_loans(raw: DataFrame) -> DataFrame:
    return days_past_due(enforce_types(raw, S.LOAN_TYPES))


def silver_clickstream(raw: DataFrame) -> DataFrame:
    return enforce_types(raw, S.CLICK_TYPES).withColumns({c: C.clamp_low(c) for c in S.CLICK_COLUMNS})


def silver_attributes(raw: DataFrame) -> DataFrame:
    occupation = F.when(F.col("Occupation") == BLANK_OCCUPATION, F.lit(None).cast("string"))
    for old, new in OCCUPATION_RENAMES.items():
        occupation = occupation.when(F.col("Occupation") == old, F.lit(new))
    cleaned = raw.withColumns(
        {
            "Name": C.person_name("Name"),
            "Age": C.digits_int("Age"),
            "SSN": C.matching("SSN", SSN_PATTERN),
            "Occupation": occupation.otherwise(F.col("Occupation")),
        }
    )
    return cleaned.withColumn("Age", C.within("Age", *AGE_RANGE))


def clean_financials(raw: DataFrame) -> DataFrame:
    """Money, integers, ratios, credit age and the encoded categories.

    Signs go with the other non-digits, so a negative entry counts as its absolute value.
    Limits apply in a second projection, which keeps each text to a single parse.
    """
    numbers = {C.money: S.MONEY_COLUMNS, C.digits_int: S.INTEGER_COLUMNS, C.digits_double: S.RATIO_COLUMNS}
    cleaned = C.by_rule(raw, numbers).withColumns(
        {
            "Credit_History_Age": C.months_from_text("Credit_History_Age"),
            "Credit_Mix": C.ordinal("Credit_Mix", S.CREDIT_MIX_LEVELS),
            "Payment_of_Min_Amount": C.yes_no("Payment_of_Min_Amount"),
            "Payment_Behaviour": C.ordinal("Payment_Behaviour", S.PAYMENT_BEHAVIOUR_LEVELS),
        }
    )
    return cleaned.withColumns({c: C.cap(c, high) for c, high in CAPS.items()})


def engineer_ratios(clean: DataFrame) -> DataFrame:
    """Product counts and affordability ratios; NULL inputs give NULL."""
    return clean.withColumns({name: F.expr(rule) for name, rule in ENGINEERED.items()})


def silver_financials(raw: DataFrame) -> DataFrame:
    return engineer_ratios(clean_financials(raw))


BUILDERS = {
    "loans": silver_loans,
    "clickstream": silver_clickstream,
    "attributes": silver_attributes,
    "financials": silver_financials,
}
