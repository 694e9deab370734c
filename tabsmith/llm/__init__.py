"""Training-data operators: search, mixing, packing, extraction, filters, near duplicates, counts."""
