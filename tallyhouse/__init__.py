"""tallyhouse: sales analytics for an online marketplace, built on PySpark DataFrames."""
