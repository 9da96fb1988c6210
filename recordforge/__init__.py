"""recordforge: record cleaning, entity resolution and rule-based scoring on Spark.

Every operator is a DataFrame -> DataFrame function whose columns and rules
are parameters (see :mod:`recordforge.config` for the default configuration).
"""

__version__ = "0.1.0"
