"""functions of the tessera engine."""
