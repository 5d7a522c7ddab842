"""Operators that prepare text corpora: near-duplicates, names, reading level, leaks, mixing, splitting."""
