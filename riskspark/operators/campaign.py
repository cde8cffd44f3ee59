"""Campaign effect: treatment against control, cost and return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.parsing import treatment_arm
from riskspark.functions.rounding import round2, round4, share

# Default unit economics.
CONTACT_COST = 10.0
CUSTOMER_VALUE = 500.0


def campaign_effect(
    matched: DataFrame,
    contact_cost: float = CONTACT_COST,
    customer_value: float = CUSTOMER_VALUE,
    treatment: str = "treatment_group",
    outcome: str = "observed_churn",
) -> DataFrame:
    """One row of arm sizes, rates, reduction and money; one aggregation of the table.

    Without a treatment column, or with an empty arm, ``campaign_data_available``
    is false and the effect columns are null.
    """
    if outcome not in matched.columns:
        raise ValueError(f"matched rows lack the outcome column '{outcome}'")
    has_arms = treatment in matched.columns
    arm = treatment_arm(F.col(treatment)) if has_arms else F.lit(None).cast("string")
    rows = matched.select(arm.alias("arm"), F.col(outcome).cast("double").alias("y"))

    def count_of(name: str):
        return F.count(F.when(F.col("arm") == name, 1)).alias(f"n_{name}")

    def churned_of(name: str):
        return F.coalesce(F.sum(F.when(F.col("arm") == name, F.col("y"))), F.lit(0.0)).cast(
            "bigint"
        ).alias(f"{name}_churn_count")

    sums = rows.agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg("y").alias("overall"),
        count_of("treatment"),
        count_of("control"),
        churned_of("treatment"),
        churned_of("control"),
    )
    ok = (F.col("n_treatment") > 0) & (F.col("n_control") > 0)
    rate_t = share(F.col("treatment_churn_count"), F.col("n_treatment"), None)
    rate_c = share(F.col("control_churn_count"), F.col("n_control"), None)
    reduction = F.when(ok, rate_c - rate_t)
    relative = F.when(ok, share(rate_c - rate_t, rate_c))
    retained = reduction * F.col("n_treatment")
    cost = F.when(ok, F.col("n_treatment") * F.lit(float(contact_cost)))
    gross = retained * F.lit(float(customer_value))
    net = gross - cost
    roi = F.when(ok, share(net, cost))
    note = (
        F.when(
            ok,
            F.lit(
                f"Assumes a contact cost of {contact_cost:.2f} and a retained value of "
                f"{customer_value:.2f} per prevented loss, and comparable arms."
            ),
        ).otherwise(
            F.concat(
                F.lit("Needs non-empty treatment (found "),
                F.col("n_treatment").cast("string"),
                F.lit(") and control (found "),
                F.col("n_control").cast("string"),
                F.lit(") arms."),
            )
        )
        if has_arms
        else F.lit("No treatment column in the labels; no conclusion about lift is possible.")
    )
    return sums.select(
        ok.alias("campaign_data_available"),
        "sample_size",
        round4(F.col("overall")).alias("overall_churn_rate"),
        "n_treatment",
        "n_control",
        "treatment_churn_count",
        "control_churn_count",
        round4(rate_t).alias("treatment_churn_rate"),
        round4(rate_c).alias("control_churn_rate"),
        round4(reduction).alias("absolute_churn_reduction"),
        round2(relative * 100).alias("relative_churn_reduction_pct"),
        round2(retained).alias("estimated_incremental_retained_customers"),
        round2(cost).alias("total_campaign_cost_usd"),
        round2(gross).alias("gross_retained_margin_usd"),
        round2(net).alias("net_campaign_value_usd"),
        round2(roi * 100).alias("campaign_roi_percent"),
        note.alias("assumptions_documented"),
    )
