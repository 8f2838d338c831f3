"""tidemark: row-change records in, correct and queryable Spark tables out.

Every operator takes DataFrames and returns a DataFrame; only ``sources.state``,
``sources.ingest``, ``operators.layout`` and ``streaming`` write anything.
"""
