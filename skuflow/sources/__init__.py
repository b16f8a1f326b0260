"""Table scans, TSV readers/writers, table rebuilds and the test-data mapping."""
