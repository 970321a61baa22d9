"""sources of the tessera engine."""
