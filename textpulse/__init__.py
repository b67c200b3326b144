"""textpulse: text-sentiment analytics as Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions (cleaning, tokens, decoding, hashing)
operators   DataFrame -> DataFrame steps (cleaning, profiling, terms, metrics, lexicons)
sources     readers and writers
plans       whole flows: model training, scoring, text analysis
streaming   message replay, stream scoring, repeatable sinks
suite       the registered queries and the SQL they are checked against
"""
