"""feedforge: layered analytics for social posts and engagement events on Spark.

Every operator takes and returns DataFrames and stays lazy; the only eager
parts are the writers, the streaming starters and ``quality.enforce``.
"""
