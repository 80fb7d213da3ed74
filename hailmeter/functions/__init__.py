"""Column -> Column building blocks; no actions, usable on batch and stream."""
