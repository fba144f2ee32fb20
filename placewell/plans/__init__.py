"""Raw-to-clean transforms. Each takes and returns DataFrames."""
