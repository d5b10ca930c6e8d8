"""aeroseries - daily environmental time series and allergen severity on Spark.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from native Spark expressions.  Time-series operators take a
``partition_by`` tuple (default ``("site_id",)``) and an ``order_by`` column
(default ``"date"``); the series must be unique on ``partition_by + order_by``
(aggregate stations to sites first, see ``operators.profile.aggregate_stations``).
"""

from aeroseries.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
