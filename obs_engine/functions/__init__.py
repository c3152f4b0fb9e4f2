"""Column builders: keys, parsing and metrics. No Python UDFs."""
