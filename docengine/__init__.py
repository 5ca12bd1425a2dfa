"""docengine: document intelligence on Apache Spark.

Every operator is a function from DataFrames to a DataFrame.  Layout:

functions/   Column -> Column building blocks
sources/     table, file-stream, contract readers and table writers
operators/   DataFrame -> DataFrame operators
plans/       the daily jobs composed from the operators
streaming/   file ingest and change-driven index maintenance
contracts/   declarative data contracts (YAML)
"""

__version__ = "0.1.0"
