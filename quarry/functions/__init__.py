"""Column expressions: text rules, fixed values, optional tokenizer UDFs."""
