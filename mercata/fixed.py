"""Results depend on these exact settings, so they are stated once, here."""

# Order statuses that count as a finished delivery.
COMPLETED = ("Delivered", "Delivered Late")
DELIVERED = "Delivered"
LATE = "Delivered Late"
CANCELLED = "Cancelled"

# Historic or alternative city names.
CITY_ALIASES = {
    "Bangalore": "Bengaluru",
    "Bombay": "Mumbai",
    "Madras": "Chennai",
    "New Delhi": "Delhi",
    "Baroda": "Vadodara",
}

DELIVERY_MINUTES_RANGE = (5, 180)
TRAFFIC_TOLERANCE_MINUTES = 90
CHURN_HORIZON_DAYS = 60
MONEY_TOLERANCE = 0.01
RELATIVE_TOLERANCE = 1e-5
EARTH_RADIUS_KM = 6371.0088
SEED = 42

# Model settings.
DELIVERY_TEST_FRACTION = 0.20
CHURN_TEST_FRACTION = 0.15
CHURN_VALIDATION_FRACTION = 0.15
MIN_CATEGORY_ROWS = 10
TREES = 150
TREE_DEPTH = 12
LEAF_ROWS = 3
RIDGE_ALPHA = 5.0
LOGISTIC_ITERATIONS = 2500
THRESHOLD_FIRST, THRESHOLD_LAST, THRESHOLD_COUNT = 0.10, 0.90, 81
