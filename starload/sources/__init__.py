"""Sources: Parquet and CSV files, JDBC, any registered Spark data source."""
