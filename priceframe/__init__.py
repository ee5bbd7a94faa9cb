"""priceframe: price-index panel analytics as Spark DataFrame operators.

Every operator takes a DataFrame (plus column names) and returns a DataFrame;
nothing pulls row data to the driver.  See README.md for the module map.
"""

__version__ = "0.1.0"
