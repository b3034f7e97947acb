"""Declared schemas of the inputs and of every published table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
FEE = T.DecimalType(10, 2)
DELTA = T.DecimalType(18, 4)
PERCENT = T.DecimalType(5, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DateType()

RELATIONSHIP_MANAGERS = _struct(rm_id=_S, rm_name=_S, rm_grade=_S, team=_S)
PRODUCTS = _struct(product_id=_S, product_name=_S, product_category=_S, is_core_product=_I)
CUSTOMERS = _struct(
    customer_id=_S,
    customer_name=_S,
    customer_type=_S,
    onboarding_date=_D,
    relationship_manager=_S,
    region=_S,
    is_active=_I,
)
TRANSACTIONS = _struct(
    transaction_id=_S,
    customer_id=_S,
    product_id=_S,
    transaction_date=_D,
    transaction_type=_S,
    channel=_S,
    transaction_value=MONEY,
    fee_revenue=FEE,
)

CUSTOMER_360 = _struct(
    customer_id=_S,
    snapshot_date=_D,
    revenue_ltm=MONEY,
    revenue_90d=MONEY,
    revenue_prior_90d=MONEY,
    revenue_delta_pct=DELTA,
    txn_count_90d=_I,
    txn_count_prior_90d=_I,
    txn_volume_90d=MONEY,
    txn_delta_pct=DELTA,
    products_active=_I,
    products_total=_I,
    product_depth_pct=PERCENT,
    primary_channel=_S,
    digital_txn_pct=PERCENT,
    rfm_recency_score=_I,
    rfm_frequency_score=_I,
    rfm_monetary_score=_I,
    days_since_last_txn=_I,
    activity_trend=_S,
)
CUSTOMER_SEGMENTS = _struct(
    customer_id=_S, snapshot_date=_D, segment=_S, prior_segment=_S, segment_change=_S
)
CUSTOMER_HEALTH = _struct(
    customer_id=_S,
    snapshot_date=_D,
    activity_health=PERCENT,
    revenue_health=PERCENT,
    recency_health=PERCENT,
    engagement_health=PERCENT,
    health_score=PERCENT,
    health_category=_S,
    health_trend=_S,
)
CONCENTRATION = _struct(
    snapshot_date=_D,
    total_portfolio_revenue=MONEY,
    top_10_revenue=MONEY,
    top_10_pct=PERCENT,
    top_20_revenue=MONEY,
    top_20_pct=PERCENT,
    top_50_revenue=MONEY,
    top_50_pct=PERCENT,
    revenue_dependency_score=_S,
    scenario_top10_exit_risk=MONEY,
    scenario_critical_exit_risk=MONEY,
)
RM_ACTIONS = _struct(
    action_id=_S,
    customer_id=_S,
    snapshot_date=_D,
    segment=_S,
    health_category=_S,
    action_type=_S,
    action_description=_S,
    priority=_S,
    sla_days=_I,
    assigned_rm=_S,
    status=_S,
)
EXCEPTIONS = _struct(
    exception_id=_S,
    customer_id=_S,
    detected_date=_D,
    exception_type=_S,
    description=_S,
    severity=_S,
    recommended_action=_S,
    assigned_rm=_S,
    status=_S,
)
EXECUTIVE_KPIS = _struct(
    snapshot_date=_D,
    total_customers=_I,
    active_customers=_I,
    dormant_customers=_I,
    healthy_pct=PERCENT,
    critical_pct=PERCENT,
    revenue_concentration_pct=PERCENT,
    open_retain_actions=_I,
    open_crosssell_actions=_I,
    open_reactivation_actions=_I,
    customers_at_risk=_I,
    revenue_at_risk=MONEY,
    open_exceptions=_I,
    open_p1_exceptions=_I,
)

KEYS = {
    "dim_relationship_managers": "rm_id",
    "dim_products": "product_id",
    "dim_customers": "customer_id",
    "stg_transactions": "transaction_id",
    "fct_customer_360": "customer_id",
    "fct_customer_segments": "customer_id",
    "fct_customer_health": "customer_id",
    "fct_concentration": "snapshot_date",
    "fct_rm_actions": "action_id",
    "fct_exceptions": "exception_id",
    "fct_executive_kpis": "snapshot_date",
}


def conform(df: DataFrame, schema: T.StructType, keep_key_type: str | None = None) -> DataFrame:
    """Select the schema's columns by name, cast to their declared types.

    ``keep_key_type`` names a key column left as it is: customer ids may be numeric in
    a source, and a numeric key shuffles and compares faster than its text.
    """
    return df.select(
        *[
            F.col(f.name) if f.name == keep_key_type else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def typed(df: DataFrame, schema: T.StructType, keep_key_type: str) -> DataFrame:
    """Columns of ``df`` that the schema declares, cast to their types; others are left as they are.

    A column of the right type is left alone, so nothing stands between a filter on it and the scan.
    """
    kinds = {f.name: f.dataType for f in schema if f.name != keep_key_type}
    casts = {
        f.name: F.col(f.name).cast(kinds[f.name]) for f in df.schema if f.name in kinds and f.dataType != kinds[f.name]
    }
    return df.withColumns(casts) if casts else df
