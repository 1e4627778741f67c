"""Readers, slices, landing and the lake."""
