"""Energy time-series analytics as lazy Spark DataFrame functions.

Shapes used throughout:

* readings -- ``[series columns..., timestamp, value]``, the large input;
* daily    -- ``[series columns..., date, value]``, one row per series and day;
* season   -- ``[series columns..., season key, year columns..., statistics]``.

Functions take and return DataFrames and start no job, but for the sinks and the
quarantine mode of the unit check.
``series`` is always a list of column names; it may be empty for one series.
"""

__version__ = "0.1.0"
