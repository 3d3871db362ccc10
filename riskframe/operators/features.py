"""Derived credit features.

Each family is one ``withColumns`` of native expressions: the plan stays a
single projection inside whole-stage codegen. Column names default to the
credit table's; pass another name for any role. Null rules: a comparison
with a missing operand is False; a ratio with a zero denominator is missing
(and E7 then fills it with the median, as inf -> NaN -> median did).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import flag, row_mean, row_std, safe_div
from riskframe.operators.impute import inf_to_null_median_fill
from riskframe.session import written

c = F.col

# Credit-score bands (right-closed) and their labels.
SCORE_BANDS = [(0, 500, "very_poor"), (500, 600, "poor"), (600, 700, "fair"),
               (700, 800, "good"), (800, 1000, "excellent")]

SAV = ["SAVINGS_BALANCE_M1", "SAVINGS_BALANCE_M2", "SAVINGS_BALANCE_M3"]
CHK = ["CHECKING_BALANCE_M1", "CHECKING_BALANCE_M2", "CHECKING_BALANCE_M3"]


def balance_flags(df: DataFrame, savings=SAV, checking=CHK) -> DataFrame:
    """F1-F3 (pipeline 1): HAS_NEGATIVE_BALANCE, SAVINGS_TREND, CHECKING_TREND."""
    return df.withColumns({
        "HAS_NEGATIVE_BALANCE": flag((c(checking[0]) < 0) | (c(checking[1]) < 0) | (c(checking[2]) < 0)),
        "SAVINGS_TREND": c(savings[0]) - c(savings[2]),
        "CHECKING_TREND": c(checking[0]) - c(checking[2]),
    })


def financial_features(df: DataFrame, savings=SAV, checking=CHK, income="INCOME_MONTHLY",
                       expenses="EXPENSES_MONTHLY", installment="MONTHLY_INSTALLMENT",
                       loan="LOAN_AMOUNT", dti="DTI_RATIO") -> DataFrame:
    """F4-F14."""
    tot = [c(s) + c(k) for s, k in zip(savings, checking)]
    exp_ratio = safe_div(c(expenses), c(income) + 1)
    return df.withColumns({
        "SAVINGS_TO_INCOME": safe_div(c(savings[0]), c(income) + 1),
        "CHECKING_TO_INCOME": safe_div(c(checking[0]), c(income) + 1),
        "TOTAL_BALANCE_M1": tot[0], "TOTAL_BALANCE_M2": tot[1], "TOTAL_BALANCE_M3": tot[2],
        "AVG_TOTAL_BALANCE": (tot[0] + tot[1] + tot[2]) / 3,
        "LOAN_TO_ANNUAL_INCOME": safe_div(c(loan), c(income) * 12 + 1),
        "REPAYMENT_CAPACITY": c(income) - c(expenses) - c(installment),
        "EXPENSE_RATIO": exp_ratio,
        "FINANCIAL_MARGIN": c(income) - c(expenses),
        "FINANCIAL_STRESS": flag((c(dti) > 0.4) | (exp_ratio > 0.7)),
    })


def behavioural_features(df: DataFrame, pos="POS_TXN_COUNT_30D", atm="ATM_TXN_COUNT_30D",
                         online="ONLINE_TXN_COUNT_30D", mobile="MOBILE_LOGINS_30D",
                         web="WEB_LOGINS_30D", branch="BRANCH_VISITS_6M",
                         withdrawal="LAST_WITHDRAWAL_AMOUNT", deposit="LAST_DEPOSIT_AMOUNT") -> DataFrame:
    """F15-F21."""
    total = c(pos) + c(atm) + c(online)
    logins = c(mobile) + c(web)
    return df.withColumns({
        "TOTAL_TXN_30D": total,
        "ONLINE_TXN_RATIO": safe_div(c(online), total + 1),
        "TOTAL_DIGITAL_LOGINS": logins,
        "MOBILE_PREFERENCE": safe_div(c(mobile), logins + 1),
        "DIGITAL_ENGAGEMENT": logins + c(online) * 2,
        "IS_BRANCH_ACTIVE": flag(c(branch) >= 2),
        "WITHDRAWAL_DEPOSIT_RATIO": safe_div(c(withdrawal), c(deposit) + 1),
    })


def stability_features(df: DataFrame, savings=SAV, checking=CHK, seniority="SENIORITY_YEARS",
                       residence="RESIDENCE_SINCE_YEARS") -> DataFrame:
    """F22-F28 (+ the two trends again, as the original assigns them here)."""
    s_std = row_std(savings)
    s_trend = c(savings[0]) - c(savings[2])
    k_trend = c(checking[0]) - c(checking[2])
    return df.withColumns({
        "SAVINGS_STABILITY": s_std,
        "CHECKING_STABILITY": row_std(checking),
        "BALANCE_CV": safe_div(s_std, F.abs(row_mean(savings)) + 1),
        "SAVINGS_TREND": s_trend,
        "SAVINGS_TREND_RATIO": safe_div(s_trend, F.abs(c(savings[2])) + 1),
        "CHECKING_TREND": k_trend,
        "CHECKING_TREND_RATIO": safe_div(k_trend, F.abs(c(checking[2])) + 1),
        "EMPLOYMENT_STABILITY": flag(c(seniority) >= 2),
        "RESIDENCE_STABILITY": flag(c(residence) >= 2),
    })


def fit_score_range(df: DataFrame, score="CREDIT_SCORE", fit_df: DataFrame | None = None) -> tuple:
    """F30 fit: (min, max) of the score over the fitting frame."""
    r = (fit_df if fit_df is not None else df).agg(F.min(c(score).cast("double")),
                                                   F.max(c(score).cast("double"))).first()
    return r[0], r[1]


def risk_features(df: DataFrame, late="NUM_LATE_PAYMENTS_12M", prev_default="HAS_PREVIOUS_DEFAULT",
                  inquiries="INQUIRIES_6M", utilization="UTILIZATION_RATE", dti="DTI_RATIO",
                  score="CREDIT_SCORE", open_loans="NUM_OPEN_LOANS", limit="TOTAL_CREDIT_LIMIT",
                  seniority="SENIORITY_YEARS", score_range: tuple | None = None,
                  fit_df: DataFrame | None = None) -> DataFrame:
    """F29-F34. The score range is fitted once (two numbers) and inlined."""
    lo, hi = score_range or fit_score_range(df, score, fit_df)
    s = c(score).cast("double")
    cat = F.lit(None).cast("string")
    for a, b, label in reversed(SCORE_BANDS):
        cat = F.when((s > a) & (s <= b), F.lit(label)).otherwise(cat)
    return df.withColumns({
        "RISK_SCORE_CUSTOM": c(late) * 10 + c(prev_default) * 20 + c(inquiries) * 5
        + flag(c(utilization) > 0.7, "int") * 15 + flag(c(dti) > 0.5, "int") * 10,
        "CREDIT_SCORE_NORM": safe_div(s - F.lit(lo), F.lit(hi) - F.lit(lo)) if lo is not None
        else F.lit(None).cast("double"),
        "CREDIT_SCORE_CAT": cat,
        "LOAN_UTILIZATION": safe_div(c(open_loans), c(limit) / 10000 + 1),
        "HIGH_RISK_FLAG": flag((c(late) >= 2) | (c(prev_default) == 1) | (s < 550) | (c(dti) > 0.6)),
        "IS_NEW_CLIENT": flag((c(seniority) < 1) & (c(open_loans) == 0)),
    })


def interaction_features(df: DataFrame, age="AGE", seniority="SENIORITY_YEARS", income="INCOME_MONTHLY",
                         dti="DTI_RATIO", utilization="UTILIZATION_RATE", loan="LOAN_AMOUNT",
                         rate="INTEREST_RATE", term="LOAN_TERM_MONTHS") -> DataFrame:
    """F35-F39 (needs CREDIT_SCORE_NORM and AVG_TOTAL_BALANCE first)."""
    return df.withColumns({
        "AGE_SENIORITY": c(age) * c(seniority),
        "INCOME_CREDIT_SCORE": c(income) * c("CREDIT_SCORE_NORM"),
        "DTI_UTILIZATION": c(dti) * c(utilization),
        "LOAN_INTEREST_COST": c(loan) * c(rate),
        "BALANCE_LOAN_TERM": safe_div(c("AVG_TOTAL_BALANCE"), c(term) + 1),
    })


def engineer_features(df: DataFrame, fill_exclude=("CLIENT_ID", "TARGET"),
                      fit_df: DataFrame | None = None) -> DataFrame:
    """every family in order, then E7 (inf/NaN -> null -> median).

    With ``fit_df`` every fitted value, the fill medians included, comes from
    its rows after the same derivation. The derived frame is written once, so
    that the passes for the medians and the result scan plain columns.
    """
    def derive(d: DataFrame) -> DataFrame:
        return (d.transform(financial_features).transform(behavioural_features)
                .transform(stability_features)
                .transform(lambda x: risk_features(x, fit_df=fit_df))
                .transform(interaction_features))

    return inf_to_null_median_fill(written(derive(df), "features"), exclude=fill_exclude,
                                   fit_df=None if fit_df is None else written(derive(fit_df), "features-fit"))


ENGINEERED = ["SAVINGS_TO_INCOME", "CHECKING_TO_INCOME", "TOTAL_BALANCE_M1", "TOTAL_BALANCE_M2",
              "TOTAL_BALANCE_M3", "AVG_TOTAL_BALANCE", "LOAN_TO_ANNUAL_INCOME", "REPAYMENT_CAPACITY",
              "EXPENSE_RATIO", "FINANCIAL_MARGIN", "FINANCIAL_STRESS", "TOTAL_TXN_30D",
              "ONLINE_TXN_RATIO", "TOTAL_DIGITAL_LOGINS", "MOBILE_PREFERENCE", "DIGITAL_ENGAGEMENT",
              "IS_BRANCH_ACTIVE", "WITHDRAWAL_DEPOSIT_RATIO", "SAVINGS_STABILITY", "CHECKING_STABILITY",
              "BALANCE_CV", "SAVINGS_TREND", "SAVINGS_TREND_RATIO", "CHECKING_TREND",
              "CHECKING_TREND_RATIO", "EMPLOYMENT_STABILITY", "RESIDENCE_STABILITY", "RISK_SCORE_CUSTOM",
              "CREDIT_SCORE_NORM", "CREDIT_SCORE_CAT", "LOAN_UTILIZATION", "HIGH_RISK_FLAG",
              "IS_NEW_CLIENT", "AGE_SENIORITY", "INCOME_CREDIT_SCORE", "DTI_UTILIZATION",
              "LOAN_INTEREST_COST", "BALANCE_LOAN_TERM"]
