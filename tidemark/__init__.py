"""tidemark: feature engineering, data quality and drift monitoring on Spark."""
