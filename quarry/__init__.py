"""quarry — table-level analytics jobs written as Spark DataFrame plans.

Every public job takes DataFrames plus plain parameters and returns a
DataFrame; Catalyst plans the work, nothing is collected except tiny
bounded parameter tables (k-means centres, code tables under a size check).
"""

__version__ = "0.1.0"
