"""DataFrame-in / DataFrame-out jobs (inventory groups B–I)."""
