"""People-flow analytics on Spark: tracks, zones, counting lines, rollups and reports."""
