"""sunledger: photovoltaic fleet analytics as PySpark DataFrame operators.

Every operator takes DataFrames plus an explicit ``as_of`` moment (a naive UTC
``datetime``) and returns a lazy DataFrame.  See README.md for the layer map.
"""

__version__ = "0.1.0"
