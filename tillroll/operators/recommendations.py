"""Rule-based recommendations from the sales totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.totals import OVERALL, leakage, retained_share, sales_totals

# The texts of the recommendations, with %s for the category or payment method.
LOW_NRR_RULE = "NRR below 90%"
LOW_NRR_ACTION = "Reduce broad discount campaigns and enforce category-level caps."
LOW_NRR_OWNER = "Revenue Operations"
CATEGORY_RULE = "Highest leakage category is %s"
CATEGORY_ACTION = "Run a 2-week pricing policy test in %s with tighter discount thresholds."
CATEGORY_OWNER = "Category Management"
PAYMENT_RULE = "Lowest average ticket on %s"
PAYMENT_ACTION = "Adjust promotion mechanics for %s to increase ticket size."
PAYMENT_OWNER = "Commercial Strategy"
NO_RISK_RULE = "No material risk detected"
NO_RISK_ACTION = "Maintain current policy and continue weekly KPI monitoring."
NO_RISK_OWNER = "Analytics"


def _facts(totals: DataFrame) -> DataFrame:
    """What the rules look at, as one row from one pass over the totals.

    One pass matters: a branch per fact would let Spark prune each to its own columns and
    scan the sales rows once per branch. An extreme is ordered by (metric is null, metric,
    key), which puts nulls last and settles ties by the key; rows of other dimensions have a
    null order and do not take part.
    """

    def whole(measure: str) -> Column:
        value = F.max(F.when(F.col("dimension") == OVERALL, F.col(measure)))
        return F.coalesce(value, F.lit(0.0)).alias(measure)

    def first(dimension: str, metric: Column, shown: str) -> Column:
        order = F.struct(metric.isNull(), metric, F.col("key"))
        return F.min_by(shown, F.when(F.col("dimension") == dimension, order))

    discount = -F.col("discount_value")
    return totals.agg(
        whole("total_revenue"),
        whole("gross_revenue"),
        first("product_category", discount, "key").alias("product_category"),
        first("product_category", discount, "discount_value").alias("category_discount"),
        first("payment_method", F.col("avg_ticket"), "key").alias("payment_method"),
    )


def _recommendation(
    priority: str, rule: Column, action: Column, impact: Column, owner: str
) -> Column:
    return F.struct(
        F.lit(priority).alias("priority"),
        rule.alias("decision_rule"),
        action.alias("recommended_action"),
        impact.cast("double").alias("expected_impact_usd"),
        F.lit(owner).alias("owner_area"),
    )


def build_actionable_recommendations(
    df: DataFrame,
    *,
    nrr_floor: float = 0.9,
    recovery: float = 0.05,
    ticket_uplift: float = 0.01,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Apply the rules to the totals; each rule that fires gives one row.

    All rows of the sales table are reduced to ``sales_totals`` first, in one scan.
    """
    if totals is None:
        totals = sales_totals(df, "total_revenue", "gross_revenue", "discount_value", "avg_ticket")
    category, payment = F.col("product_category"), F.col("payment_method")
    below_floor = F.when(
        retained_share() < nrr_floor,
        _recommendation(
            "high",
            F.lit(LOW_NRR_RULE),
            F.lit(LOW_NRR_ACTION),
            F.when(F.col("gross_revenue") != 0, leakage() * recovery).otherwise(0.0),
            LOW_NRR_OWNER,
        ),
    )
    leaking_category = F.when(
        category.isNotNull(),
        _recommendation(
            "high",
            F.format_string(CATEGORY_RULE, category),
            F.format_string(CATEGORY_ACTION, category),
            F.col("category_discount") * recovery,
            CATEGORY_OWNER,
        ),
    )
    small_tickets = F.when(
        payment.isNotNull(),
        _recommendation(
            "medium",
            F.format_string(PAYMENT_RULE, payment),
            F.format_string(PAYMENT_ACTION, payment),
            F.col("total_revenue") * ticket_uplift,
            PAYMENT_OWNER,
        ),
    )
    no_risk = _recommendation(
        "low", F.lit(NO_RISK_RULE), F.lit(NO_RISK_ACTION), F.lit(0.0), NO_RISK_OWNER
    )
    fired = F.array_compact(F.array(below_floor, leaking_category, small_tickets))
    return (
        _facts(totals)
        .select(fired.alias("fired"))
        .select(F.inline(F.when(F.size("fired") == 0, F.array(no_risk)).otherwise(F.col("fired"))))
        .orderBy("priority", F.desc_nulls_last("expected_impact_usd"), "decision_rule")
    )
