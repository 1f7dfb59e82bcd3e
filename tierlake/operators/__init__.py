"""DataFrame -> DataFrame operators of the three tiers."""
