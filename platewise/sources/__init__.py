"""Readers and writers. Readers return lazily evaluated DataFrames with explicit schemas."""
