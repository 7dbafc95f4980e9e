"""Card-payment risk analytics on Apache Spark."""
