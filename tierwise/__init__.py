"""tierwise — a layered (Bronze / Silver / Gold) warehouse built on PySpark DataFrames.

Layers:
  * Bronze: raw copy of an operational table, loaded incrementally by a high-water mark and
    upserted by key (soft-deleted rows stay).
  * Silver: one cleansing projection (snake_case, trimmed text, an ``is_deleted`` flag).
  * Gold: five aggregate marts over Silver.

Data-quality checks are DataFrames of violations; a build stops at the first failing layer.
Every clock-dependent value takes ``as_of`` as a parameter so results are reproducible.

Entry points: ``tierwise.sources.source.read_source`` (the operational table),
``tierwise.plans.pipeline.run_hourly`` (one gated, checked, incremental build) and
``tierwise.plans.pipeline.register_views`` (ad-hoc SQL over every layer).
"""

__all__ = ["schemas", "functions", "sources", "operators", "plans", "streaming"]
