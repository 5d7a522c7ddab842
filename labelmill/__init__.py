"""Drug-label analytics on PySpark: sources, column functions, operators and query plans."""
