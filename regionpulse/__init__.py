"""Regional alert analytics on Spark DataFrames.

Dated reports, daily rain series and earthquake points go in; per-region alert
tables come out.  Everything is a ``DataFrame -> DataFrame`` operator or a
column function, so a job is one lazy plan until its writes.
"""

__version__ = "0.1.0"
