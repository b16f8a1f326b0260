"""DataFrame -> DataFrame operators (joins, aggregates, windows, models)."""
