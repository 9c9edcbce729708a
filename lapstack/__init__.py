"""Event-results analytics on Spark: races, entries, laps, stops and standings."""
