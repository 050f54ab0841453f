"""tillroll — a layered retail warehouse as pure Spark DataFrame operators.

Layers: CSV landing -> bronze (typed Parquet) -> silver (data-quality gate,
conformed dimensions, item-grain fact) -> gold (aggregate marts).

Every operator takes and returns DataFrames, triggers no action, caches
nothing and changes no session setting; only ``tillroll.plans.pipeline``
writes tables.
"""

__version__ = "0.1.0"
