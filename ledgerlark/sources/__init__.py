"""Sources of the engine."""
