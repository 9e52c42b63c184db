"""Batch and event analytics on Spark DataFrames.

Raw string tables are cast and cleaned tolerantly, the latest version of each record is
kept, every rejected row is accounted for, facts are joined to dimensions and rolled up
into marts with ranks, running totals and rolling sums; keyed tables are upserted, results
are reconciled through zero-row checks, and summary rows become keyed JSON events that are
written, replayed and deduplicated with Structured Streaming.

Every function takes and returns DataFrames; nothing opens a session and nothing collects
unbounded data to the driver.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
