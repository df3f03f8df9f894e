"""pluvia: DataFrame operators for tidy tables, places, event studies and data quality on Spark."""
