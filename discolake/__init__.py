"""Music-catalogue lakehouse transforms on Spark DataFrames.

Bronze documents are landed by ingest date, flattened to silver tables and
bridge tables, aggregated to gold statistics, kept incremental with key
tables, and fed by a stream of track events.  Every transform takes and
returns DataFrames and uses built-in expressions only.
"""
