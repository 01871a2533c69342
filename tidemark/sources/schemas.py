"""Declared schemas: raw events, feature sources and feature views."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The raw event schema.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("transaction_amount", T.DoubleType(), True),
        T.StructField("transaction_type", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
        T.StructField("country_code", T.StringType(), True),
        T.StructField("is_fraud", T.BooleanType(), True),
    ]
)


@dataclass(frozen=True)
class Source:
    """A time-versioned table on disk."""

    name: str
    path: str
    fmt: str = "parquet"
    ts_col: str = "event_timestamp"
    created_col: str | None = "created_timestamp"


@dataclass(frozen=True)
class FeatureView:
    """Named, typed features of an entity, valid for ``ttl_days`` after their time."""

    name: str
    keys: tuple[str, ...]
    ttl_days: int | None
    fields: dict[str, str] = field(hash=False)
    source: str
    online: bool = True
    ts_col: str = "event_timestamp"
    created_col: str | None = "created_timestamp"


# Names of the four declared sources.
SOURCE_NAMES = (
    "transactions_source",
    "credit_bureau_source",
    "customer_profile_source",
    "fraud_labels_source",
)

# The declared feature views (names, types, time to live).
TRANSACTION_VIEW = FeatureView(
    name="customer_transaction_features",
    keys=("customer_id",),
    ttl_days=7,
    source="transactions_source",
    fields={
        "avg_spend_7d": "double",
        "total_spend_7d": "double",
        "transaction_count_7d": "long",
        "transaction_count_30d": "long",
        "avg_spend_30d": "double",
        "std_spend_30d": "double",
        "fraud_rate_90d": "double",
        "fraud_count_90d": "long",
        "unique_merchants_30d": "long",
        "max_single_spend_30d": "double",
        "international_txn_ratio_30d": "double",
    },
)

CREDIT_VIEW = FeatureView(
    name="credit_features",
    keys=("customer_id",),
    ttl_days=35,
    source="credit_bureau_source",
    fields={
        "credit_utilization": "double",
        "payment_history_score": "double",
        "debt_to_income": "double",
        "num_open_accounts": "long",
        "num_derogatory_marks": "long",
        "credit_age_months": "long",
        "recent_hard_inquiries_6m": "long",
        "installment_utilization": "double",
        "months_since_last_delinquency": "long",  # -1 stands for "none"
        "estimated_credit_score": "double",
    },
)

PROFILE_VIEW = FeatureView(
    name="customer_profile_features",
    keys=("customer_id",),
    ttl_days=90,
    source="customer_profile_source",
    fields={
        "account_age_days": "long",
        "customer_segment": "string",
        "kyc_verified": "boolean",
        "product_count": "long",
        "annual_income_band": "string",
        "state_code": "string",
        "channel": "string",
    },
)

LABEL_VIEW = FeatureView(
    name="fraud_label_features",
    keys=("transaction_id",),
    ttl_days=365,
    source="fraud_labels_source",
    online=False,
    fields={
        "is_fraud": "boolean",
        "fraud_type": "string",
        "investigation_status": "string",
    },
)

VIEWS = {v.name: v for v in (TRANSACTION_VIEW, CREDIT_VIEW, PROFILE_VIEW, LABEL_VIEW)}

# Feature reference groups per model.
FRAUD_REFS = (
    "customer_transaction_features:avg_spend_7d",
    "customer_transaction_features:total_spend_7d",
    "customer_transaction_features:transaction_count_7d",
    "customer_transaction_features:transaction_count_30d",
    "customer_transaction_features:std_spend_30d",
    "customer_transaction_features:fraud_rate_90d",
    "customer_transaction_features:fraud_count_90d",
    "customer_transaction_features:unique_merchants_30d",
    "customer_transaction_features:international_txn_ratio_30d",
    "customer_profile_features:account_age_days",
    "customer_profile_features:customer_segment",
    "customer_profile_features:kyc_verified",
)
CREDIT_REFS = (
    "credit_features:credit_utilization",
    "credit_features:payment_history_score",
    "credit_features:debt_to_income",
    "credit_features:num_open_accounts",
    "credit_features:num_derogatory_marks",
    "credit_features:credit_age_months",
    "credit_features:recent_hard_inquiries_6m",
    "credit_features:months_since_last_delinquency",
    "credit_features:estimated_credit_score",
    "customer_transaction_features:avg_spend_30d",
    "customer_transaction_features:transaction_count_30d",
    "customer_profile_features:annual_income_band",
    "customer_profile_features:product_count",
)
FRAUD_LABEL_REFS = ("fraud_label_features:is_fraud", "fraud_label_features:fraud_type")
CHURN_REFS = (
    "user_transaction_features:tx_count_7d",
    "user_transaction_features:tx_amount_sum_30d",
    "user_transaction_features:tx_amount_mean_90d",
    "user_transaction_features:tx_amount_stddev_30d",
    "user_transaction_features:is_high_value_customer",
    "user_profile_features:account_age_days",
    "user_profile_features:kyc_verified",
)


def parse_refs(refs) -> dict[str, list[str]]:
    """Group ``view:feature`` references by view, in order of first mention."""
    grouped: dict[str, list[str]] = {}
    for ref in refs:
        view, sep, feature = ref.partition(":")
        if not sep or not view or not feature:
            raise ValueError(f"not a view:feature reference: {ref!r}")
        names = grouped.setdefault(view, [])
        if feature not in names:
            names.append(feature)
    return grouped
