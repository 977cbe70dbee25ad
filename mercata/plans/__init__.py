"""Domain plans: cleaning, validation, business queries, features, models."""
