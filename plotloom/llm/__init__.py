"""Training-data operators on document tables: cleaning, scoring, tokenising, near-duplicates."""
