"""The reference's multi-step flows as compositions of plover operators.

``clean_loans`` = LW's filter/label/parse cell; ``munge_loans`` = its second
munging cell; ``FeatureSpec`` = its role lists.  Each has a SQL twin used by
the oracles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.functions import (
    label_from_status,
    merge_levels,
    net_amount,
    parse_month_year,
    parse_percent,
    parse_tenure,
)
from plover.plans import standins as S

# Fixed values of the loan flow (the reference's literals): statuses, good status, merged level,
# selected columns and the model's role lists.
LOAN_STATUSES = ["Default", "Charged Off", "Fully Paid"]
GOOD_STATUS = "Fully Paid"
VERIFICATION_MERGE = {"Source Verified": "Verified"}
LOAN_COLUMNS = ["loan_status", "int_rate", "revol_util", "issue_d", "earliest_cr_line", "emp_length",
                "verification_status", "total_pymnt", "loan_amnt", "grade", "annual_inc", "dti", "addr_state",
                "term", "home_ownership", "purpose", "application_type", "delinq_2yrs", "total_acc"]
CATEGORICALS = ["term", "home_ownership", "purpose", "addr_state", "verification_status", "application_type"]
NUMERICS = ["loan_amnt", "emp_length", "annual_inc", "dti", "delinq_2yrs", "revol_util", "total_acc",
            "credit_length_in_years"]
RESPONSE = "bad_loan"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@dataclass(frozen=True)
class FeatureSpec:
    """Role lists of the loan model (categorical / numeric / response)."""

    categoricals: list[str] = field(default_factory=lambda: list(CATEGORICALS))
    numerics: list[str] = field(default_factory=lambda: list(NUMERICS))
    response: str = RESPONSE

    @property
    def inputs(self) -> list[str]:
        return self.categoricals + self.numerics


def clean_loans(raw: DataFrame) -> DataFrame:
    """Filter to final statuses, label, parse percent / year / tenure text (one projection)."""
    df = raw.filter(F.col("loan_status").isin(LOAN_STATUSES))
    return df.withColumns({
        "bad_loan": label_from_status("loan_status", GOOD_STATUS),
        "int_rate": parse_percent("int_rate"),
        "revol_util": parse_percent("revol_util"),
        "issue_year": parse_month_year("issue_d"),
        "earliest_year": parse_month_year("earliest_cr_line"),
        "emp_length": parse_tenure("emp_length"),
    }).withColumn("credit_length_in_years", F.col("issue_year") - F.col("earliest_year"))


def munge_loans(clean: DataFrame) -> DataFrame:
    """Merge verification levels and add the money column ``net``."""
    return clean.withColumns({
        "verification_status": merge_levels("verification_status", VERIFICATION_MERGE),
        "net": net_amount("total_pymnt", "loan_amnt"),
    })


def loans_clean(spark, sf):
    return clean_loans(S.loans_raw(spark, sf))


def loans_munged(spark, sf):
    return munge_loans(loans_clean(spark, sf))


# ------------------------------------------------------------------ SQL twins
_TENURE_SQL = ("TRY_CAST(trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(emp_length, "
               "'([ ]*[a-zA-Z].*)|(n/a)', '', 'g')), '< 1', '0', 'g')), '10\\+', '10', 'g')) AS DOUBLE)")


def loans_clean_sql() -> str:
    statuses = ", ".join(f"'{s}'" for s in LOAN_STATUSES)
    inner = f"""SELECT * EXCLUDE (int_rate, revol_util, emp_length),
  CAST(NOT (loan_status = '{GOOD_STATUS}') AS VARCHAR) AS bad_loan,
  TRY_CAST(trim(replace(int_rate, '%', '')) AS DOUBLE) AS int_rate,
  TRY_CAST(trim(replace(revol_util, '%', '')) AS DOUBLE) AS revol_util,
  TRY_CAST(substring(issue_d, 5, 4) AS DOUBLE) AS issue_year,
  TRY_CAST(substring(earliest_cr_line, 5, 4) AS DOUBLE) AS earliest_year,
  {_TENURE_SQL} AS emp_length
FROM ({S.loans_raw_sql()}) r WHERE loan_status IN ({statuses})"""
    return f"SELECT *, issue_year - earliest_year AS credit_length_in_years FROM ({inner}) c"


def loans_munged_sql() -> str:
    return (f"SELECT * REPLACE (trim(replace(verification_status, 'Source Verified', 'Verified')) AS verification_status),"
            f" round(total_pymnt - loan_amnt, 2) AS net FROM ({loans_clean_sql()}) m")
