"""Query catalogue: the jobs wired to the driver tables, and their SQL oracles."""
