"""Fixed values of the business: rates, weights, hours, price bands. Plain data, used as defaults."""

from __future__ import annotations

# Category -> (lowest, highest) unit price.
PRICE_BANDS = {
    "Dairy": (10, 60),
    "Bakery": (5, 40),
    "Beverages": (8, 50),
    "Snacks": (5, 35),
    "Frozen": (15, 80),
    "Produce": (3, 30),
    "Meat & Poultry": (30, 120),
    "Household": (10, 80),
    "Personal Care": (10, 70),
    "Baby": (15, 90),
}
DEFAULT_PRICE_BAND = (5, 50)
PURCHASE_PRICE_SHARE = "0.70"
DEFAULT_DELIVERY_FEE = "20.00"

# Workday, first and last hour.
DAY_START_HOUR = 8
DAY_END_HOUR = 22

# Probability of each kind of event per tick.
EVENT_MIX = (
    ("order_create", 0.60),
    ("advance_order", 0.20),
    ("customer_registration", 0.10),
    ("stock_adjust", 0.05),
    ("restock_check", 0.05),
)
MAX_EVENT_PROBABILITY = 0.95

# Traffic intensity of hours 0 to 23; any other hour counts 1.0.
HOURLY_INTENSITY = (
    0.05, 0.02, 0.02, 0.02, 0.02, 0.05, 0.10, 0.30, 0.50, 0.80, 0.70, 0.75,
    1.00, 1.10, 0.90, 0.80, 0.85, 1.00, 1.20, 1.40, 1.10, 0.70, 0.30, 0.10,
)

# Share of orders that move on.
CONFIRM_RATE = 0.85
DELIVER_RATE = 0.95

# Expected payment methods and basket sizes.
PAYMENT_MIX = {"card": 0.45, "cash": 0.30, "wallet": 0.25}
BASKET_MIX = {1: 0.20, 2: 0.30, 3: 0.25, 4: 0.15, 5: 0.10}

# Longest delay in minutes, jitter included, before an order should be confirmed, delivered.
CONFIRM_LIMIT_MINUTES = 19
DELIVER_LIMIT_MINUTES = 58

STALE_HOURS = 48
PHONE_PATTERN = "^01[0125] [1-9][0-9]{7}$"
