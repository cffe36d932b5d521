"""Surface-water analytics on Spark: DataFrame operators from radar pixel cloud to lake products."""
