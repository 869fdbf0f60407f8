"""matchlake: layered football analytics (raw -> conformed -> star -> reports) on Spark.

Every public function takes and returns DataFrames; nothing is collected to the
driver except tiny status rows.  See README.md for the module map.
"""

__version__ = "0.1.0"
