"""quarry: DataFrame operators for tabular, series, spectra, voxel and web-page analytics on Spark.

Every operator takes a DataFrame (plus column names and parameters) and returns a DataFrame.
The core work runs on executors; only small statistics (min/max, vocabularies, model
coefficients) ever reach the driver.
"""

__version__ = "0.1.0"
