"""Patronscope: user profiling, RFM features, clustering and prompts as Spark jobs.

Operators take DataFrames and return DataFrames. They never create a session,
never hold paths, and never bring rows to the driver.
"""
