"""ledgerline: Spark-native CRM and campaign-operations analytics.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregations and windows, so Catalyst plans it and the
work is partitioned across the cluster.

Layout
------
``sources``    readers and adapters producing the canonical facts
``functions``  column-expression helpers (money, months, campaign names)
``operators``  financial (F), CRM (K), operations (O), quality (Q), periods (P)
``plans``      the query registry used by ``__spark_entry__`` and its SQL oracles
``streaming``  Structured Streaming jobs for the daily operations feed
"""

__all__ = ["session"]
