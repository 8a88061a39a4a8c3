"""Contact unification and training-data operators on PySpark DataFrames."""
