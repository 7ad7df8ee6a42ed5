"""Named analytics per case family, the query catalog and the oracle SQL."""
