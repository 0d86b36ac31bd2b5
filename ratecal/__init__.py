"""Rate-calendar analytics: hotel quotes in cash and points, as Spark DataFrame operators."""
