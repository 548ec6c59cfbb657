"""Native column expressions: Column in, Column out, no Python UDFs."""
