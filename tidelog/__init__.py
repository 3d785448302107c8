"""tidelog: change-data analytics on Spark DataFrames.

A change log of inserts, updates and deletes is landed as partitioned raw
tables, checked row by row, turned into versioned dimension history and
latest-state facts, joined point in time and summarised.  Every function takes
and returns DataFrames; nothing is collected, and no Python UDF is used.
"""
