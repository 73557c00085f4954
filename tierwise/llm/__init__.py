"""Operators for training-data pipelines (each module is one operator; nothing else imports this package)."""
