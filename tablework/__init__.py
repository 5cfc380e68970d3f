"""Table and stream operators for everyday analytics engineering on Spark."""
