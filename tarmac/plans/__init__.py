"""Query plans: fixture derivation, end-to-end builds, registry, oracle SQL."""
