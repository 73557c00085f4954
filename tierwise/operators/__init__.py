"""tierwise.operators."""
