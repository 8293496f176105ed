"""Fork-aware event tables on Spark."""
