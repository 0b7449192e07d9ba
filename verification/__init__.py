"""The registered queries, their SQL equivalents, and a local comparison run."""
