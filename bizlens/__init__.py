"""bizlens: business-analytics operators as Spark DataFrame functions.

Every public operator takes DataFrames (plus parameters) and returns a
DataFrame.  Nothing collects data to the driver; planning is left to
Catalyst and AQE.
"""

__version__ = "0.1.0"
