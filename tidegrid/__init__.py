"""tidegrid: demand analytics on a place-by-hour grid, written as PySpark DataFrame operators."""
