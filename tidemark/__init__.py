"""Keep many lakehouse tables in step with a relational change log, on Spark."""
