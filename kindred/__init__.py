"""User-based collaborative filtering as Spark DataFrame plans."""
