"""operators of the tessera engine."""
