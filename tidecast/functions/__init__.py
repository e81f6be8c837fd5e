"""Column functions: rounding, timestamps, text cleaning, sentiment scores."""
