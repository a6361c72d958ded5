"""Table and JDBC sources and sinks."""
