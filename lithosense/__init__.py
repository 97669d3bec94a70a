"""Sensor time-series analytics and section-year modelling on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns); nothing here
holds data on the driver.  See README.md for the map from task to module.
"""

__version__ = "0.1.0"
