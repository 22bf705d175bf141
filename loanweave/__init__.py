"""Credit-risk feature engineering as Spark DataFrame and MLlib jobs."""
