"""recordlens: Spark-native analytics over published technical records.

The library turns raw delimited record files into four normalised tables
(patents, inventors, companies, relationships) and answers analytical
questions over them as plain Spark DataFrames.  Every operator is a
function from DataFrames to a DataFrame; nothing is collected to the
driver except bounded, fixed-size metadata (partition offsets, headers).
"""

__version__ = "0.1.0"
