"""orderlake: Spark-native operators for an order-event lakehouse.

Raw JSON order events are parsed, validated and duplicate-tagged into a
Bronze table, typed into Silver facts and a type-2 customer dimension,
aggregated into Gold facts with serving views, and gated by single-pass
data-quality and reconciliation checks.  Every operator is a pure
``DataFrame -> DataFrame`` function; writers live in ``sources.tables``.
"""

__version__ = "0.1.0"
