"""hearsay: public-mention analytics as PySpark DataFrame transforms."""
