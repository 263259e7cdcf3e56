"""Feed analytics on PySpark: landing, staging, hourly facts, star schema, alerts and contracts."""
