"""Supply-risk analytics as plain PySpark: DataFrames in, one lazy DataFrame out."""
