"""ANSI SQL counterparts of the registered queries, written for DuckDB on the test tables."""

from __future__ import annotations

# Written out here, so that a column missing in the package is missing on one side only.
MONEY = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]
INTEGERS = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
    "Interest_Rate",
]
RATIOS = ["Changed_Credit_Limit", "Credit_Utilization_Ratio"]
ENGINEERED = ["Num_Fin_Pdts", "Loans_per_Credit_Item", "Debt_to_Salary", "EMI_to_Salary", "Repayment_Ability", "Loan_Extent"]
RISKS = [
    "Credit_History_Age", "Num_Fin_Pdts", "EMI_to_Salary", "Debt_to_Salary", "Repayment_Ability", "Loans_per_Credit_Item",
    "Loan_Extent", "Outstanding_Debt", "Interest_Rate", "Delay_from_due_date", "Changed_Credit_Limit",
]

MONTH = "cast(date_trunc('month', {}) as date)"

RAW_LOANS = f"""
raw_loans as (
  select concat('L', l_orderkey, '-', l_linenumber) as loan_id,
         concat('CUS_', o_custkey) as Customer_ID,
         cast(o_orderdate as date) as loan_start_date,
         cast(l_quantity / 2 as varchar) as tenure,
         l_linenumber as installment_num,
         cast(l_extendedprice as float) as loan_amt,
         cast(case l_orderkey % 97 when 0 then 0.0001::double when 1 then 0.0000001::double else l_extendedprice / 10 end as float)
           as due_amt,
         case when l_tax > 0 then cast(l_extendedprice * l_tax as float) end as paid_amt,
         cast((cast(round(l_discount * 100) as int) % 4) * l_extendedprice * 0.09::double as float) as overdue_amt,
         cast(l_extendedprice * (1 - l_discount) as float) as balance,
         {MONTH.format('l_shipdate')} as snapshot_date
  from lineitem join orders on l_orderkey = o_orderkey)"""

MONTHLY = f"""
monthly as (
  select o_custkey, {MONTH.format('o_orderdate')} as snapshot_date, min(o_totalprice) as low_price, count(*) as n_orders,
         min(c_acctbal) as c_acctbal, min(c_nationkey) as c_nationkey
  from orders join customer on o_custkey = c_custkey group by 1, 2)"""

FE_REST = ",\n         ".join(
    f"case when o_custkey % {i + 20} <> 0 then cast((visits + balance * {i}) % {i * 100} - 50 as int) end as fe_{i}"
    for i in range(3, 21)
)
RAW_CLICKS = f"""
raw_clicks as (
  select visits as fe_1, balance as fe_2,
         {FE_REST},
         concat('CUS_', o_custkey) as Customer_ID, snapshot_date
  from (select *, cast(floor(low_price) as int) as visits, cast(floor(c_acctbal) as int) as balance from monthly))"""

RAW_ATTRIBUTES = """
raw_attributes as (
  select concat('CUS_', c_custkey) as Customer_ID,
         case when c_custkey % 19 <> 0 then ' ' || c_name || ' O''Neil-' || c_mktsegment || '!2 ' end as Name,
         case when c_custkey % 7 = 0 then concat('-', c_custkey % 130) else concat(c_custkey % 130, '_') end as Age,
         case when c_custkey % 5 = 0 then '#F%$D@*&8'
              else concat(lpad(cast(c_custkey % 1000 as varchar), 3, '0'), '-', lpad(cast(c_custkey % 100 as varchar), 2, '0'),
                          '-', lpad(cast(c_custkey % 10000 as varchar), 4, '0')) end as SSN,
         case c_mktsegment when 'HOUSEHOLD' then '_______' when 'MACHINERY' then 'Media_Manager' else c_mktsegment end as Occupation,
         cast(date '1995-01-01' + to_months(cast(c_custkey % 84 as int)) as date) as snapshot_date
  from customer)"""

HABITS = """
           when 0 then 'Low_spent_Small_value_payments' when 1 then 'Low_spent_Medium_value_payments'
           when 2 then 'Low_spent_Large_value_payments' when 3 then 'High_spent_Small_value_payments'
           when 4 then 'High_spent_Medium_value_payments' when 5 then 'High_spent_Large_value_payments'"""
RAW_FINANCIALS = f"""
raw_financials as (
  select concat('CUS_', o_custkey) as Customer_ID,
         concat(cast(c_acctbal as varchar), '_') as Annual_Income,
         case when o_custkey % 13 = 0 then '' else cast(c_acctbal as varchar) end as Monthly_Inhand_Salary,
         cast(low_price as varchar) as Outstanding_Debt,
         concat('__', cast(c_nationkey * 10 as varchar), '__') as Total_EMI_per_month,
         case when o_custkey % 17 = 0 then '__10000__' else concat('$', cast(low_price as varchar)) end as Amount_invested_monthly,
         case when o_custkey % 23 <> 0 then concat('-', cast(c_acctbal as varchar), '_') end as Monthly_Balance,
         cast(o_custkey % 15 as varchar) as Num_Bank_Accounts,
         concat(o_custkey % 12, '_') as Num_Credit_Card,
         cast(o_custkey % 11 - 1 as varchar) as Num_of_Loan,
         cast(n_orders * 7 - 10 as varchar) as Delay_from_due_date,
         concat(o_custkey % 60, '_') as Num_of_Delayed_Payment,
         case when o_custkey % 31 <> 0 then cast(o_custkey % 40 as varchar) end as Num_Credit_Inquiries,
         cast(o_custkey % 50 as varchar) as Interest_Rate,
         case when o_custkey % 6 = 0 then '_' else cast(round(c_acctbal, 1) as varchar) end as Changed_Credit_Limit,
         case when o_custkey % 10 = 0 then concat('-', cast(low_price as varchar)) else cast(low_price as varchar) end
           as Credit_Utilization_Ratio,
         case when o_custkey % 9 = 0 then 'NA' else concat(o_custkey % 30, ' Years and ', o_custkey % 12, ' Months') end
           as Credit_History_Age,
         case o_custkey % 4 when 0 then 'Bad' when 1 then 'Standard' when 2 then 'Good' else '_' end as Credit_Mix,
         case o_custkey % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end as Payment_of_Min_Amount,
         case o_custkey % 7 {HABITS} else '!@9#%8' end as Payment_Behaviour,
         snapshot_date
  from monthly)"""

SILVER_LOANS = """
typed_loans as (
  select loan_id, Customer_ID, loan_start_date,
         coalesce(cast(trunc(try_cast(tenure as double)) as int), 0) as tenure,
         coalesce(installment_num, 0) as installment_num,
         coalesce(loan_amt, 0)::float as loan_amt, coalesce(due_amt, 0)::float as due_amt,
         coalesce(paid_amt, 0)::float as paid_amt, coalesce(overdue_amt, 0)::float as overdue_amt,
         coalesce(balance, 0)::float as balance, snapshot_date,
         coalesce(cast(case when owed > 2147483647 then 2147483647 else owed end as int), 0) as installments_missed
  from (select *, ceil(overdue_amt::double / nullif(due_amt::double, 0)) as owed from raw_loans)),
dated_loans as (
  select *, installment_num as mob,
         case when installments_missed between 1 and 12 * (year(snapshot_date) - 1)
              then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
  from typed_loans),
silver_loans as (
  select *, case when overdue_amt > 0 and installments_missed > 0
                 then cast(date_diff('day', coalesce(first_missed_date, date '0001-01-01'), snapshot_date) as int)
                 when overdue_amt > 0 then null else 0 end as dpd
  from dated_loans)"""

CLAMPED = ",\n         ".join(f"case when fe_{i} < 0 then 0 else fe_{i} end as fe_{i}" for i in range(1, 21))
SILVER_CLICKS = f"""
silver_clicks as (
  select {CLAMPED}, Customer_ID, snapshot_date from raw_clicks)"""

SILVER_ATTRIBUTES = r"""
silver_attributes as (
  select Customer_ID,
         trim(regexp_replace(Name, '[^A-Za-z .''-]', '', 'g')) as Name,
         case when age_number between 0 and 100 then age_number end as Age,
         case when regexp_matches(SSN, '^\d{3}-\d{2}-\d{4}$') then SSN end as SSN,
         case Occupation when '_______' then null when 'Media_Manager' then 'Media Manager' else Occupation end as Occupation,
         snapshot_date
  from (select *, try_cast(regexp_replace(Age, '\D', '', 'g') as int) as age_number from raw_attributes))"""


def _money(name: str) -> str:
    return f"round(try_cast(regexp_replace({name}, '[^\\d.]', '', 'g') as double), 3) as {name}"


def _integer(name: str) -> str:
    caps = {
        "Num_Bank_Accounts": 10,
        "Num_Credit_Card": 10,
        "Interest_Rate": 34,
        "Num_of_Loan": 9,
        "Num_of_Delayed_Payment": 47,
        "Num_Credit_Inquiries": 26,
    }
    value = f"try_cast(regexp_replace({name}, '\\D', '', 'g') as int)"
    if name not in caps:
        return f"{value} as {name}"
    return f"case when {value} > {caps[name]} then {caps[name]} else {value} end as {name}"


def _ratio(name: str) -> str:
    return f"try_cast(regexp_replace({name}, '[^\\d.]', '', 'g') as double) as {name}"


CLEANED = ",\n         ".join(
    [_money(c) for c in MONEY] + [_integer(c) for c in INTEGERS] + [_ratio(c) for c in RATIOS]
)
SILVER_FINANCIALS = rf"""
clean_financials as (
  select Customer_ID, snapshot_date,
         {CLEANED},
         try_cast(regexp_extract(Credit_History_Age, '^(\d+) Years and (\d+) Months', 1) as int) * 12
           + try_cast(regexp_extract(Credit_History_Age, '^(\d+) Years and (\d+) Months', 2) as int) as Credit_History_Age,
         case Credit_Mix when 'Bad' then 0 when 'Standard' then 1 when 'Good' then 2 end as Credit_Mix,
         case Payment_of_Min_Amount when 'Yes' then true when 'No' then false end as Payment_of_Min_Amount,
         case Payment_Behaviour
           when 'Low_spent_Small_value_payments' then 0 when 'Low_spent_Medium_value_payments' then 1
           when 'Low_spent_Large_value_payments' then 2 when 'High_spent_Small_value_payments' then 3
           when 'High_spent_Medium_value_payments' then 4 when 'High_spent_Large_value_payments' then 5
         end as Payment_Behaviour
  from raw_financials),
silver_financials as (
  select *,
         Num_Bank_Accounts + Num_Credit_Card + Num_of_Loan as Num_Fin_Pdts,
         Num_of_Loan::double / (Num_Bank_Accounts + Num_Credit_Card + 1)::double as Loans_per_Credit_Item,
         Outstanding_Debt / (Monthly_Inhand_Salary + 1) as Debt_to_Salary,
         Total_EMI_per_month / (Monthly_Inhand_Salary + 1) as EMI_to_Salary,
         Monthly_Inhand_Salary - Total_EMI_per_month as Repayment_Ability,
         Delay_from_due_date * Num_of_Loan as Loan_Extent
  from clean_financials)"""

LABELS = """
labels_gold as (
  select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def, snapshot_date
  from silver_loans where mob = 6)"""

LAG_COLUMNS = ", ".join(f"max(case when months_ago = {i} then fe_1 end) as click_{i}m" for i in range(1, 7))
ENGAGEMENT = f"""
lagged as (
  select Customer_ID, fe_1, months_ago, cast(snapshot_date + to_months(months_ago) as date) as snapshot_date
  from (select Customer_ID, fe_1, snapshot_date, unnest([1, 2, 3, 4, 5, 6])::int as months_ago from silver_clicks)),
engagement as (
  select Customer_ID, snapshot_date, {LAG_COLUMNS}
  from lagged where snapshot_date in (select snapshot_date from silver_loans)
  group by Customer_ID, snapshot_date)"""

RISK = f"""
risk as (
  select Customer_ID, snapshot_date, {', '.join(RISKS)} from silver_financials)"""

MODEL_TABLE = """
model_table as (
  select * from labels_gold
  left join engagement using (Customer_ID, snapshot_date)
  left join risk using (Customer_ID, snapshot_date))"""

MODEL_PARTS = [
    MONTHLY, RAW_LOANS, RAW_CLICKS, RAW_FINANCIALS, SILVER_LOANS, SILVER_CLICKS, SILVER_FINANCIALS,
    LABELS, ENGAGEMENT, RISK, MODEL_TABLE,
]


def _placed(rows: str) -> str:
    return f"""
placed as (
  select *, cast('0x' || substr(md5(loan_id || '|42'), 1, 8) as bigint) as place from {rows})"""


SHARE = "case when place < 3006477107 then 'train' when place < 3865470566 then 'test' else 'val' end"


def _split(rows: str, n_train: int, n_oot: int) -> list[str]:
    return [
        f"""
months as (
  select snapshot_date, cast(row_number() over (order by snapshot_date) as int) as month_rank, count(*) over () as loaded
  from (select distinct snapshot_date from {rows}))""",
        _placed(rows),
        f"""
splits as (
  select placed.* exclude (place),
         case when month_rank <= {n_train} then {SHARE}
              when month_rank <= {n_train + n_oot} then 'oot' || (month_rank - {n_train})
              else 'monitor' end as split
  from placed join months using (snapshot_date) where loaded >= {n_train})""",
    ]


def _scored(rows: str) -> str:
    return f"""
scored as (
  select *, coalesce(Interest_Rate, 0)::double * 0.25::double + coalesce(Loan_Extent, 0)::double * 0.125::double
            + coalesce(Outstanding_Debt, 0) / 100000 + coalesce(click_1m, 0)::double / 50000 as score
  from {rows})"""


def _auc(rows: str, label: str, score: str, by: str, name: str = "auc") -> list[str]:
    """Rank form of the area: mean rank of the bad rows, ties sharing their middle rank."""
    return [
        f"""
ranked as (
  select {by} as grp, {label} as y,
         rank() over (partition by {by} order by {score})
           + (count(*) over (partition by {by}, {score}) - 1) / 2.0::double as mid
  from {rows} where {label} is not null and {score} is not null)""",
        f"""
areas as (
  select grp as {by},
         (sum(case when y = 1 then mid else 0::double end) - sum(y)::double * (sum(y) + 1) / 2)
           / nullif(sum(y)::double * (count(*) - sum(y)), 0) as {name}
  from ranked group by grp)""",
    ]


def _query(parts: list[str], select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select


FIN = [MONTHLY, RAW_FINANCIALS, SILVER_FINANCIALS]
LOANS = [RAW_LOANS, SILVER_LOANS]
CLICKS = [MONTHLY, RAW_CLICKS, SILVER_CLICKS]


def _fin(columns: list[str]) -> str:
    return _query(FIN, f"select Customer_ID, snapshot_date, {', '.join(columns)} from silver_financials")


LABEL_COUNTS = (
    "select snapshot_date, label_def, count(*) as row_count, cast(sum(label) as bigint) as bad_count, "
    "avg(label) as bad_rate from {} group by 1, 2"
)
SCORED_PARTS = [*MODEL_PARTS, *_split("model_table", 12, 3), _scored("splits")]



def _text(view: str, cell: str) -> str:
    """The dated rows of a raw view, with one dirty cell as it should read."""
    return f"""
text_{view} as (
  select * replace ({cell}) from raw_{view} where Customer_ID not like '%7')"""


SOURCE_VIEWS = [("loans", "loans"), ("clickstream", "clicks"), ("attributes", "attributes"), ("financials", "financials")]
NONE = "cast(null as bigint)"
RUN_COUNTS = "\nunion all ".join(
    [
        f"""select 'bronze' as layer, '{name}' as table_name, count(*) as rows_in, count(*) filter (Customer_ID like '%7') as undated,
       {NONE} as repeated_rows, count(*) filter (Customer_ID not like '%7') as rows_out
from {'twice' if view == 'financials' else 'raw_' + view}"""
        for name, view in SOURCE_VIEWS
    ]
    + [
        f"select 'silver', '{name}', {NONE}, {NONE}, {NONE}, count(*) from {'twice' if view == 'financials' else 'raw_' + view} where Customer_ID not like '%7'"
        for name, view in SOURCE_VIEWS
    ]
    + [
        f"select 'gold', 'risk', {NONE}, {NONE}, count(*) filter (Customer_ID like '%5') // 2, count(*) from twice where Customer_ID not like '%7'",
        f"select 'gold', 'engagement', {NONE}, {NONE}, {NONE}, count(*) from engagement",
        *[f"select 'gold', '{name}', {NONE}, {NONE}, {NONE}, count(*) from labels_gold" for name in ("label_store", "model_table")],
    ]
)

ORACLE = {
    "bronze_snapshot_slice": _query([RAW_LOANS], "select * from raw_loans where snapshot_date = date '1998-06-01'"),
    "bronze_counts_by_snapshot": _query(
        [MONTHLY, RAW_LOANS, RAW_CLICKS, RAW_ATTRIBUTES, RAW_FINANCIALS],
        "\nunion all ".join(
            f"select '{name}' as source_table, snapshot_date, count(*) as row_count from raw_{view} group by 2"
            for name, view in [
                ("loans", "loans"),
                ("clickstream", "clicks"),
                ("attributes", "attributes"),
                ("financials", "financials"),
            ]
        ),
    ),
    "csv_ingest": _query([MONTHLY, RAW_FINANCIALS], "select * replace (nullif(Monthly_Inhand_Salary, '') as Monthly_Inhand_Salary) from raw_financials"),
    "silver_loans_from_text": _query(
        [
            RAW_LOANS,
            _text("loans", "case when Customer_ID not like '%1' then balance end as balance"),
            SILVER_LOANS.replace("raw_loans", "text_loans"),
        ],
        "select * from silver_loans",
    ),
    "silver_clickstream_from_text": _query(
        [
            MONTHLY,
            RAW_CLICKS,
            _text("clicks", "case when Customer_ID not like '%1' then fe_3 end as fe_3"),
            SILVER_CLICKS.replace("raw_clicks", "text_clicks"),
        ],
        "select * from silver_clicks",
    ),
    "silver_attributes_from_text": _query(
        [
            RAW_ATTRIBUTES,
            _text("attributes", "case when Customer_ID like '%1' then 'x' when Customer_ID like '%3' then Name || '.7' else Name end as Name"),
            SILVER_ATTRIBUTES.replace("raw_attributes", "text_attributes"),
        ],
        "select * from silver_attributes",
    ),
    "silver_financials_from_text": _query(
        [
            MONTHLY,
            RAW_FINANCIALS,
            _text(
                "financials",
                "case when Customer_ID like '%1' then 'x' when Customer_ID like '%3' then Interest_Rate || '.7' else Interest_Rate end as Interest_Rate",
            ),
            SILVER_FINANCIALS.replace("raw_financials", "text_financials"),
        ],
        "select * from silver_financials",
    ),
    "bronze_rejected_lines": _query(
        [MONTHLY, RAW_LOANS, RAW_CLICKS, RAW_ATTRIBUTES, RAW_FINANCIALS],
        "\nunion all ".join(
            f"""select '{name}' as source_table, case right(Customer_ID, 1) when '2' then 'too many cells' when '4' then 'too few cells'
         when '6' then 'unclosed quote' else 'read' end as reason, count(*) as row_count from raw_{view} group by 2"""
            for name, view in SOURCE_VIEWS
        ),
    ),
    "csv_three_headers": _query(
        [
            MONTHLY,
            RAW_FINANCIALS,
            """
numbered as (
  select * replace (nullif(Monthly_Inhand_Salary, '') as Monthly_Inhand_Salary), cast(regexp_extract(Customer_ID, '[0-9]+$') as int) % 3 as part
  from raw_financials)""",
        ],
        """select * exclude (part) from numbered where part = 1
union all by name select * exclude (part, Credit_Mix, Interest_Rate, Monthly_Balance) from numbered where part = 2
union all by name select * exclude (part), 'B, ' || Num_of_Loan as Branch from numbered where part = 0""",
    ),
    "run_counts": _query(
        [
            *MODEL_PARTS[:4],
            RAW_ATTRIBUTES,
            *[f"""
known_{view} as (select * from raw_{view} where Customer_ID not like '%7')""" for view in ("loans", "clicks", "attributes", "financials")],
            *[part.replace("raw_", "known_") for part in (SILVER_LOANS, SILVER_CLICKS)],
            LABELS,
            ENGAGEMENT,
            """
twice as (select Customer_ID from raw_financials union all select Customer_ID from raw_financials where Customer_ID like '%5')""",
        ],
        RUN_COUNTS,
    ),
    "attributes_store": _query([RAW_ATTRIBUTES, SILVER_ATTRIBUTES], "select * from silver_attributes"),
    "bronze_rejected_rows": _query(
        [MONTHLY, RAW_LOANS, RAW_CLICKS, RAW_ATTRIBUTES, RAW_FINANCIALS],
        "\nunion all ".join(
            f"select '{name}' as source_table, count(*) as row_count from raw_{view} where Customer_ID like '%7' "
            "group by snapshot_date is null"
            for name, view in [
                ("loans", "loans"),
                ("clickstream", "clicks"),
                ("attributes", "attributes"),
                ("financials", "financials"),
            ]
        ),
    ),
    "month_calendar": _query(
        [RAW_LOANS],
        """select snapshot_date, count(loan_id) as row_count
from (select cast(unnest(generate_series((select min(snapshot_date) from raw_loans),
                                         (select max(snapshot_date) from raw_loans), interval 1 month)) as date) as snapshot_date)
left join raw_loans using (snapshot_date) group by 1""",
    ),
    "silver_loans": _query(LOANS, "select * from silver_loans"),
    "silver_dpd_distribution": _query(
        LOANS, "select mob, installments_missed, dpd, count(*) as row_count from silver_loans group by 1, 2, 3"
    ),
    "silver_clickstream_clamp": _query(CLICKS, "select * from silver_clicks"),
    "silver_attributes": _query([RAW_ATTRIBUTES, SILVER_ATTRIBUTES], "select * from silver_attributes"),
    "silver_fin_money": _fin(MONEY),
    "silver_fin_integers_capped": _fin(INTEGERS),
    "silver_fin_credit_age": _fin(["Credit_History_Age"]),
    "silver_fin_ratios_clean": _fin(RATIOS),
    "silver_fin_encodings": _fin(["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]),
    "silver_fin_engineered": _fin(ENGINEERED),
    "gold_labels": _query([*LOANS, LABELS], "select * from labels_gold"),
    "gold_engagement": _query([*LOANS, *CLICKS, ENGAGEMENT], "select * from engagement"),
    "gold_risk": _query([*FIN, RISK], "select * from risk"),
    "model_table": _query(MODEL_PARTS, "select * from model_table"),
    "split_assignment": _query(
        [*LOANS, LABELS, _placed("labels_gold")], f"select loan_id, snapshot_date, {SHARE} as split from placed"
    ),
    "split_policy_by_month": _query([*MODEL_PARTS, *_split("model_table", 12, 3)], "select * from splits"),
    "split_policy_early_gate": _query(
        [*LOANS, LABELS, *_split("labels_gold", 6, 3)],
        "select split, snapshot_date, count(*) as row_count, cast(sum(label) as bigint) as bad_count from splits group by 1, 2",
    ),
    "bad_rate_by_mob": _query(
        LOANS,
        """select mob, avg(case when dpd >= 30 then 1 else 0 end) as bad_rate, count(*) as row_count
from silver_loans where loan_start_date < date '2000-01-01' group by 1""",
    ),
    "actual_bads": _query(
        LOANS,
        """select *, case when dpd >= 30 then 1 else 0 end as dpd_flag
from silver_loans where loan_start_date < date '2000-01-01' and installment_num = 7""",
    ),
    "label_profile": _query([*LOANS, LABELS], LABEL_COUNTS.format("labels_gold")),
    "auc_by_group": _query(
        _auc("(select * from labels join documents using (doc_id))", "quality", "n_chars", "lang"), "select * from areas"
    ),
    "holdout_auc": _query([*SCORED_PARTS, *_auc("scored", "label", "score", "split")], "select * from areas"),
    "auc_by_snapshot": _query(
        [*SCORED_PARTS, *_auc("scored", "label", "score", "snapshot_date", "test_auc")],
        "select * from areas where snapshot_date between date '1996-01-01' and date '1999-12-31'",
    ),
    "auc_trailing_window": _query(
        [*MODEL_PARTS, _scored("model_table"), *_auc("scored", "label", "score", "snapshot_date", "test_auc")],
        """select * from areas
where snapshot_date between (select max(snapshot_date) from scored) - 365 and (select max(snapshot_date) from scored)""",
    ),
    "monitoring_series": _query(
        [*SCORED_PARTS, *_auc("(select * from scored where split = 'test')", "label", "score", "snapshot_date", "test_auc")],
        "select * from areas where snapshot_date between date '1995-03-01' and date '1995-09-30'",
    ),
    "monitoring_ranges": _query(
        [
            *SCORED_PARTS,
            """
ranges as (
  select split || ' ' || name as grp, split, name as over, label, score
  from scored, (values ('manifest', date '1900-01-01', date '2100-01-01'), ('1995-03-01 to 1995-09-30', date '1995-03-01', date '1995-09-30'),
                       ('1995-06-01 to 1998-12-31', date '1995-06-01', date '1998-12-31')) as r (name, since, until)
  where split in ('test', 'val') and snapshot_date between since and until)""",
            *_auc("ranges", "label", "score", "grp"),
        ],
        "select distinct split, auc, over from areas join (select distinct grp as g, split, over from ranges) on grp = g",
    ),
    "store_roundtrip": _query([*LOANS, LABELS], LABEL_COUNTS.format("labels_gold")),
    "backfill_months": _query(MODEL_PARTS, "select * from model_table"),
    "store_rebuild": _query([*LOANS, LABELS], LABEL_COUNTS.format("labels_gold where snapshot_date >= date '1996-01-01'")),
    "splits_rebuild": _query([*MODEL_PARTS, *_split("model_table", 6, 3)], "select * from splits"),
    "model_runs": _query(
        [*MODEL_PARTS, *_split("model_table", 12, 3)],
        """select model_name, run_date, split, count(*) as row_count, cast(sum(label) as bigint) as bad_count,
       true as in_range, true as by_half, cast(1 as bigint) as areas,
       case when (model_name, split) in (('logistic', 'test'), ('other', 'val')) then count(distinct snapshot_date) else 0 end
         as monitored_months
from splits, (values ('logistic', date '2024-12-01'), ('other', date '2025-01-01')) as runs (model_name, run_date)
where split in ('test', 'val') group by 1, 2, 3""",
    ),
    "model_score_equations": _query(
        [*MODEL_PARTS, *_split("model_table", 12, 3)],
        """select split, count(*) as row_count, cast(sum(label) as bigint) as bad_count, true as in_range, true as by_half,
       case when split = 'train' then true end as balanced
from splits where split in ('train', 'test', 'val') group by 1""",
    ),
}
