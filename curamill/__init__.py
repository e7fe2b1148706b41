"""curamill: a Spark-native engine for curating text corpora.

Every stage is a function ``DataFrame, options -> DataFrame``; nothing runs until the caller writes or collects.
"""
