"""shelfscope: retail market analytics on Spark.

Raw scraper envelopes -> bronze -> silver (typed, deduplicated) -> gold
(SCD2 product dimension, daily facts, keyword and brand marts) -> SQL views
and market-entry analytics.  Every operator is ``DataFrame -> DataFrame``
built from built-in Column expressions so Catalyst can prune, push down and
code-generate the whole plan.
"""

from shelfscope.session import get_spark, shared_dir  # noqa: F401

__all__ = ["get_spark", "shared_dir"]
