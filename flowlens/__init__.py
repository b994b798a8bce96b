"""flowlens: network connection-log analytics on Spark DataFrames.

Every public function takes Spark DataFrames (plus plain parameters) and
returns a DataFrame; nothing is collected to the driver except bounded,
parameter-sized lists (pivot values, k-means centres).
"""

__version__ = "0.1.0"
