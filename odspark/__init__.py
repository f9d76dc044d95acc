"""odspark: origin-destination distances and road-network rules as Spark jobs.

Every public function takes and returns DataFrames (or Columns for the
builders in ``odspark.functions``); nothing is collected to the driver.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
