"""Root-cause analytics for daily metrics, computed with Spark DataFrames."""
