"""Writers for batches, splits, payloads and run metadata."""
