"""payloom: nested payloads in VARIANT columns to flat, typed tables on Spark."""
