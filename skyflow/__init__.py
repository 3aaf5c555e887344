"""skyflow: Spark-native operators for time-domain sky-survey tables."""
