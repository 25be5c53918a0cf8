"""The fixed values, stated once more: the DuckDB statements share the module, so a slip there would pass unseen."""

from __future__ import annotations

import pytest

from stockaudit.functions import parameters as p


def test_traffic():
    assert len(p.HOURLY_INTENSITY) == 24
    quiet = {0: 0.05, 1: 0.02, 4: 0.02, 5: 0.05, 6: 0.10, 23: 0.10}
    busy = {9: 0.80, 12: 1.00, 13: 1.10, 17: 1.00, 18: 1.20, 19: 1.40, 20: 1.10}
    for hour, value in (quiet | busy).items():
        assert p.HOURLY_INTENSITY[hour] == value
    assert sum(p.HOURLY_INTENSITY) == pytest.approx(13.78)
    assert p.MAX_EVENT_PROBABILITY == 0.95


def test_mixes():
    assert p.PAYMENT_MIX == {"card": 0.45, "cash": 0.30, "wallet": 0.25}
    assert p.BASKET_MIX == {1: 0.20, 2: 0.30, 3: 0.25, 4: 0.15, 5: 0.10}
    assert dict(p.EVENT_MIX) == {"order_create": 0.60, "advance_order": 0.20, "customer_registration": 0.10,
                                 "stock_adjust": 0.05, "restock_check": 0.05}
    for mix in (p.PAYMENT_MIX, p.BASKET_MIX, dict(p.EVENT_MIX)):
        assert sum(mix.values()) == pytest.approx(1)


def test_prices_and_limits():
    assert p.PRICE_BANDS["Dairy"] == (10, 60) and p.PRICE_BANDS["Meat & Poultry"] == (30, 120)
    assert len(p.PRICE_BANDS) == 10 and p.DEFAULT_PRICE_BAND == (5, 50)
    assert (p.PURCHASE_PRICE_SHARE, p.DEFAULT_DELIVERY_FEE) == ("0.70", "20.00")
    assert (p.DAY_START_HOUR, p.DAY_END_HOUR, p.STALE_HOURS) == (8, 22, 48)
    assert (p.CONFIRM_LIMIT_MINUTES, p.DELIVER_LIMIT_MINUTES) == (19, 58)
