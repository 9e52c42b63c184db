"""DataFrame -> DataFrame operators: cleaning, marts, ranking, weather, upserts, checks."""
