"""The registered queries over the adapter's tables, and their SQL."""
