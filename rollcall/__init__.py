"""rollcall: people-events analytics as plain Spark DataFrame programs.

Every function takes and returns DataFrames or Columns.  Nothing here starts a
session, runs Python per row, or brings table rows to the driver.
"""
