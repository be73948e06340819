"""streamlytics: event-time analytics over user-behaviour logs on Spark.

Every operator is a function ``f(df, *, columns..., parameters...) -> DataFrame``
built from DataFrame / Spark SQL primitives, so Catalyst plans it and the same
code runs on a table or (where noted) a streaming DataFrame.
"""

__version__ = "0.1.0"
