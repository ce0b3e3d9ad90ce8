"""barlab: PySpark-native analytics for time-stamped price bars.

Every public operator is a ``DataFrame -> DataFrame`` function (or a
``Column`` builder) that Catalyst can optimise end to end.  Series
semantics follow one rule: a series is the ordered rows of one
partition key, by default ``(symbol, dt)`` -- one session -- so every
window shuffles on the same key and groups stay bounded by the bar
resolution, not by the data volume.
"""

from barlab.session import get_spark, scratch_dir  # noqa: F401

SESSION_KEYS = ("symbol", "dt")
