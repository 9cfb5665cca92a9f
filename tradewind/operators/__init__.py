"""Operators on DataFrames: joins, top-k, upsert, quality, profiling, layout, lifecycle."""
