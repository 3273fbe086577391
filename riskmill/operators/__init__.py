"""Table operators: functions from DataFrame to DataFrame and Spark ML stages."""
