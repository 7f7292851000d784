"""Training-data operators: licence scan, quality rules, near-duplicate and
passage removal, token counts, byte-level BPE, exact search, packing and
URL rules. Nothing else in the library imports this subpackage."""
