"""Sources and sinks: parquet scans and writes, bronze landing, JDBC sink options,
model persistence, prediction log, and the trips view over the test tables."""
