"""marquee: a Spark-native engine for rating statistics, collaborative
filtering, content search and streaming suggestions."""

__version__ = "0.1.0"
