"""guichet: privacy-guarded support-ticket data jobs on Spark DataFrames."""
