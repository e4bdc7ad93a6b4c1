"""Search-log trends and anomalies as Spark DataFrame operators."""
