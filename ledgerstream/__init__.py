"""Tracked-entity event pipelines over ordered ledgers, as PySpark DataFrame operators."""
