"""queuelens: support-ticket SLA analytics on Spark.

Raw ticket exports are cleaned into a star schema (one fact, three
dimensions), SLA breaches are recomputed from the cleaned timestamps, and a
catalog of operational questions is answered with DataFrame / Spark SQL
plans.  Every operator is a plain ``DataFrame -> DataFrame`` function; the
only driver-side values are small query results.
"""

__version__ = "0.1.0"
