"""DataFrame -> DataFrame operators, written against column names."""
