"""Column expressions; built-in functions only. Maps and higher-order functions run outside generated code."""
