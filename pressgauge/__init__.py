"""pressgauge: topic monitoring over large news collections, as Spark DataFrame jobs."""
