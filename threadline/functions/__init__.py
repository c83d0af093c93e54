"""Column expressions: text in, arrays, maps and flags out. No UDFs."""
