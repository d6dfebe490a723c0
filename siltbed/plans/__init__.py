"""Jobs: landing, compaction, read-back, and the registered query catalog."""
