"""tierwise.plans."""
