"""Field-recording analytics on Spark: exports in, linked and summarised tables out.

Every function takes and returns DataFrames and uses built-in Spark
expressions only. Each frame carries a ``seq`` column, the recorded order of
its rows; "first" and "last" always mean by ``seq``.
"""
