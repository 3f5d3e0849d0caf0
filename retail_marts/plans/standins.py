"""Stand-in mapping: which test-table columns play the payments and ratings
sources. Kept in one place so real tables can replace them.

* Payments: ``events`` (event_id, user_id, event_type, value, ts). The test
  tables carry no payment type; ``event_type`` plays it. ``only_types``
  keeps e.g. just ``purchase`` events.
* Ratings: ``labels`` joined to ``documents``: ``quality`` (0/1) is the
  score, the document text the review comment. The tables carry no customer
  and no date for a rating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payments_source(events: DataFrame, only_types: list[str] | None = None) -> DataFrame:
    p = events.select(F.col("event_id").alias("payment_id"), F.col("user_id").alias("customer_id"),
                      F.col("event_type").alias("payment_type"), F.col("value").alias("amount"),
                      F.col("ts").alias("paid_at"))
    if only_types:
        p = p.filter(F.col("payment_type").isin(*only_types))
    return p


def ratings_source(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Inner join on doc_id (every label has its document)."""
    d = documents.select("doc_id", "text", "lang", "source")
    return (labels.join(d, "doc_id", "inner")
                  .select(F.col("doc_id").alias("rating_id"), F.col("quality").alias("score"),
                          F.col("text").alias("comment"), "lang", "source"))


def dated_ratings(ratings: DataFrame, orders: DataFrame) -> DataFrame:
    """Ratings with a month. The tables pair no rating with an order; rating i is given the date
    of order i, an *arbitrary* pairing that stands for the real one."""
    when = orders.select(F.col("order_id").alias("rating_id"), F.col("ordered_at").alias("rated_at"))
    return ratings.join(when, "rating_id", "left")


def orders_source(orders: DataFrame) -> DataFrame:
    """Orders at order grain for the customer marts."""
    return orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                         F.col("o_totalprice").alias("order_value"),
                         F.col("o_orderdate").alias("ordered_at"))
