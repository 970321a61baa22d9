"""plans of the tessera engine."""
