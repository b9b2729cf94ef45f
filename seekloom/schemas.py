"""Fixed schemas of the tables that are read and written."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("link", T.StringType(), False),
    T.StructField("html", T.StringType(), True),
])

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("link", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
])

TERM_FREQUENCIES = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("tf", T.LongType(), False),
])

DOCUMENT_FREQUENCIES = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("df", T.LongType(), False),
])

INVERSE_FREQUENCIES = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("df", T.LongType(), False),
    T.StructField("idf", T.DoubleType(), False),
])

# How postings are laid out; written once per index.
LAYOUT = T.StructType([T.StructField("word_buckets", T.IntegerType(), False)])

VECTORS = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("vector", T.ArrayType(T.FloatType(), False), False),
])

QUERIES = T.StructType([
    T.StructField("query_id", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
])

# The frontier is a queue: rounds in order, and seq within a round.
FRONTIER = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("round", T.IntegerType(), False),
    T.StructField("seq", T.LongType(), False),
])

REJECTED = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
])

EDGES = T.StructType([
    T.StructField("src", T.StringType(), False),
    T.StructField("dst", T.StringType(), False),
    T.StructField("pos", T.IntegerType(), False),
])

DONE = T.StructType([T.StructField("url", T.StringType(), False)])

ROBOTS = T.StructType([
    T.StructField("base_url", T.StringType(), False),
    T.StructField("body", T.StringType(), True),
])


def stored(schema: T.StructType, *partitions: str) -> T.StructType:
    """A table's schema with its directory columns."""
    fields = [T.StructField("batch", T.StringType(), True)]
    fields += [T.StructField(name, T.IntegerType(), True) for name in partitions]
    return T.StructType(schema.fields + fields)
