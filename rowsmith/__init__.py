"""Feature engineering and table ETL on PySpark DataFrames."""
