"""reelstar: Spark-native engagement analytics for media-streaming data.

Bronze -> silver -> gold over watch events, users, a content catalog and
late ratings: JSON stream ingest, data-quality gate, SCD2 user dimension,
conformed dimensions, incremental enrichment, a star-schema fact, daily KPIs
and per-user daily churn features - all as DataFrame plans.
"""

__version__ = "0.1.0"
