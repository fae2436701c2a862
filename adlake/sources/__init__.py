"""Readers of landed responses, and the paged request reader."""
