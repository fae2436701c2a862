"""Operators over frames: accounts, batching, flatten, checks, tables, reports."""
