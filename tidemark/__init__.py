"""tidemark — a Spark-native raw → staged → curated analytics engine for shop data.

Every operator is a function ``f(df, ...params) -> DataFrame`` built from
DataFrame / Spark SQL / Structured Streaming primitives. Writing is kept
separate from computing, and nothing collects table data to the driver.
"""

__version__ = "0.1.0"
