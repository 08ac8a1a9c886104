"""sigloom: a Spark-first engine for sampled signals, event recordings and text corpora."""

__version__ = "0.1.0"
