"""Incremental driving of the month loaders from arriving files (Structured Streaming).

The warehouse itself has no streams: late data is handled by re-loading whole months.
``month_reload_stream`` runs that same month replacement for every micro-batch of new
files (``foreachBatch``), so a dropped extract re-loads exactly the months it holds.
"""

from martspark.streaming.month_reload import month_reload_stream  # noqa: F401
