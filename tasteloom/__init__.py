"""Product recommendation analytics as PySpark DataFrame, MLlib and Structured Streaming jobs.

Every operator takes and returns DataFrames. The library never creates a session, never sets
a master URL and never changes session settings; the caller owns all of that.
"""
