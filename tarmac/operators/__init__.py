"""Flight-data transforms (normalise, stage, dedupe, models, quality, views)."""
