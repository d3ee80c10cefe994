"""reelscope: relate a catalog of shows to what people write about them, on Spark.

Every public function takes and returns DataFrames (lazy plans); only
``sources`` and ``plans.jobs`` touch storage paths.
"""

__version__ = "0.1.0"
