"""revflow: a Spark-native revenue analytics engine for CRM change feeds.

Change files are ingested with Structured Streaming, classified and stamped
(bronze), checked, quarantined and reduced to one current row per key with soft
deletes (silver), and published as business facts and marts (gold). Every
operator is a ``DataFrame -> DataFrame`` function; time is always an argument.
"""

__version__ = "0.1.0"
