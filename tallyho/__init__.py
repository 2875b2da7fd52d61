"""tallyho: which names are mentioned most, per day and right now, on Spark.

Every public function takes and returns DataFrames; nothing is collected to
the driver except bounded metadata (file listings, batch ids).
"""

__version__ = "0.1.0"
