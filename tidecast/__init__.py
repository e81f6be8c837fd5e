"""Media-audience analytics on Spark DataFrames.

Message feeds (posts, viewership, advertising) are parsed, flattened, scored and averaged in event-time
windows; results land in append-only tables and a latest-state table, and are read back by history,
export and dashboard queries.  Every operator is a DataFrame-to-DataFrame function.
"""
