"""tablemill: batch cleaning, profiling and reporting over flat tables, built on PySpark DataFrames."""
