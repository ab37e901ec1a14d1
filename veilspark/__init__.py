"""Privacy redaction and corpus jobs on Spark."""
