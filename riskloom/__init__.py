"""riskloom: customer-level credit features, screening, scoring and blending on Spark.

Everything is expressed as DataFrame / SQL plans (plus Spark ML for model fits):
feature blocks are one grouped aggregation per child table, encoders and
statistics are small dictionaries broadcast back, ranks use a bucketed
cumulative-count plan instead of a single-partition window.
"""

__version__ = "0.1.0"
