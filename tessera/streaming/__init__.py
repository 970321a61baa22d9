"""streaming of the tessera engine."""
