"""Quality measurement, cleaning and preparation of conversational training data on Spark."""
