"""How the operators are put together, and which tables are written down on the way."""
