"""The four raw sources, derived from the star-schema test tables.

Orders are reduced to one row per customer and month before they meet the customers, so
a customer with a large share of all orders is folded ahead of the shuffle.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendlake.schemas import CLICK_COLUMNS, PAYMENT_BEHAVIOUR_LEVELS


@cache
def _schema(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey").selectExpr(
        "concat('L', l_orderkey, '-', l_linenumber) as loan_id",
        "concat('CUS_', o_custkey) as Customer_ID",
        "cast(o_orderdate as date) as loan_start_date",
        "cast(l_quantity / 2 as string) as tenure",
        "l_linenumber as installment_num",
        "cast(l_extendedprice as float) as loan_amt",
        "cast(case l_orderkey % 97 when 0 then 0.0001D when 1 then 0.0000001D else l_extendedprice / 10 end as float) as due_amt",
        "if(l_tax > 0, cast(l_extendedprice * l_tax as float), null) as paid_amt",
        "cast(cast(round(l_discount * 100) as int) % 4 * l_extendedprice * 0.09D as float) as overdue_amt",
        "cast(l_extendedprice * (1 - l_discount) as float) as balance",
        "trunc(l_shipdate, 'MM') as snapshot_date",
    )


def orders_by_customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and order month, with the customer's columns."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as c_custkey", "trunc(o_orderdate, 'MM') as snapshot_date", "o_totalprice"
    )
    monthly = orders.groupBy("c_custkey", "snapshot_date").agg({"o_totalprice": "min", "*": "count"})
    monthly = monthly.withColumnsRenamed({"min(o_totalprice)": "low_price", "count(1)": "n_orders"})
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return monthly.join(customers, "c_custkey")


def raw_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = orders_by_customer_month(spark, sf_dir).selectExpr(
        "*", "cast(floor(low_price) as int) as fe_1", "cast(floor(c_acctbal) as int) as fe_2"
    )
    others = [
        f"if(c_custkey % {i + 20} != 0, (fe_1 + fe_2 * {i}) % {i * 100} - 50, null) as {name}"
        for i, name in enumerate(CLICK_COLUMNS[2:], start=3)
    ]
    return counted.selectExpr("fe_1", "fe_2", *others, "concat('CUS_', c_custkey) as Customer_ID", "snapshot_date")


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('CUS_', c_custkey) as Customer_ID",
        "if(c_custkey % 19 != 0, concat(' ', c_name, ' O\\'Neil-', c_mktsegment, '!2 '), null) as Name",
        "if(c_custkey % 7 = 0, concat('-', c_custkey % 130), concat(c_custkey % 130, '_')) as Age",
        """if(c_custkey % 5 = 0, '#F%$D@*&8',
              concat_ws('-', lpad(c_custkey % 1000, 3, '0'), lpad(c_custkey % 100, 2, '0'), lpad(c_custkey % 10000, 4, '0')))
           as SSN""",
        """case c_mktsegment when 'HOUSEHOLD' then '_______' when 'MACHINERY' then 'Media_Manager' else c_mktsegment end
           as Occupation""",
        "add_months(date'1995-01-01', cast(c_custkey % 84 as int)) as snapshot_date",
    )


def raw_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    habits = " ".join(f"when {i} then '{habit}'" for i, habit in enumerate(PAYMENT_BEHAVIOUR_LEVELS))
    return orders_by_customer_month(spark, sf_dir).selectExpr(
        "concat('CUS_', c_custkey) as Customer_ID",
        "concat(c_acctbal, '_') as Annual_Income",
        "if(c_custkey % 13 = 0, '', cast(c_acctbal as string)) as Monthly_Inhand_Salary",
        "cast(low_price as string) as Outstanding_Debt",
        "concat('__', c_nationkey * 10, '__') as Total_EMI_per_month",
        "if(c_custkey % 17 = 0, '__10000__', concat('$', low_price)) as Amount_invested_monthly",
        "if(c_custkey % 23 != 0, concat('-', c_acctbal, '_'), null) as Monthly_Balance",
        "cast(c_custkey % 15 as string) as Num_Bank_Accounts",
        "concat(c_custkey % 12, '_') as Num_Credit_Card",
        "cast(c_custkey % 11 - 1 as string) as Num_of_Loan",
        "cast(n_orders * 7 - 10 as string) as Delay_from_due_date",
        "concat(c_custkey % 60, '_') as Num_of_Delayed_Payment",
        "if(c_custkey % 31 != 0, cast(c_custkey % 40 as string), null) as Num_Credit_Inquiries",
        "cast(c_custkey % 50 as string) as Interest_Rate",
        "if(c_custkey % 6 = 0, '_', cast(round(c_acctbal, 1) as string)) as Changed_Credit_Limit",
        "if(c_custkey % 10 = 0, concat('-', low_price), cast(low_price as string)) as Credit_Utilization_Ratio",
        "if(c_custkey % 9 = 0, 'NA', concat(c_custkey % 30, ' Years and ', c_custkey % 12, ' Months')) as Credit_History_Age",
        "case c_custkey % 4 when 0 then 'Bad' when 1 then 'Standard' when 2 then 'Good' else '_' end as Credit_Mix",
        "case c_custkey % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end as Payment_of_Min_Amount",
        f"case c_custkey % 7 {habits} else '!@9#%8' end as Payment_Behaviour",
        "snapshot_date",
    )


def as_dirty_text(raw: DataFrame, column: str) -> DataFrame:
    """The source as text: cells of ``column`` that are no number or end in decimals, and snapshot dates in another format."""
    texts = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    cell = f"""case when Customer_ID like '%1' then 'x' when Customer_ID like '%3' then concat({column}, if({column} like '%.%', '', '.7'))
               else {column} end"""
    day = "if(Customer_ID like '%7', date_format(cast(snapshot_date as date), 'dd/MM/yyyy'), snapshot_date)"
    return texts.withColumns({column: F.expr(cell), "snapshot_date": F.expr(day)})


SOURCES = {
    "loans": raw_loans,
    "clickstream": raw_clickstream,
    "attributes": raw_attributes,
    "financials": raw_financials,
}
