"""Column expressions: calendar parts, cyclic encodings, guarded statistics, histograms."""
