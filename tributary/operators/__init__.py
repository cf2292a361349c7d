"""DataFrame operators: key checks, last-wins dedupe and the keyed upsert."""
