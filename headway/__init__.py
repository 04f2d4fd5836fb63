"""Headway: public-transport congestion analytics as Spark jobs.

Every function takes and returns DataFrames (or Columns); none keeps a global session and none
brings rows to the driver.
"""
