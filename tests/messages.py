"""Hand-made raw messages for the validation tests."""
import json
from datetime import datetime, timedelta

from marginwatch.config import RULES, TOPIC_OF_TYPE

NOW = datetime(2026, 10, 5, 12, 0)
START = datetime(2025, 3, 1, 8, 0)
CITIES = {"BR01": "Karachi", "BR02": "Lahore"}


def event(i, **change):
    qty, cost, price, disc = change.get("quantity", 2), change.get("unit_cost", 100), change.get("unit_price", 150), change.get("discount_pct", 0.1)
    kind = change.get("event_type", "SALE")
    revenue, spent = round(qty * price * (1 - disc), 2), round(qty * cost, 2)
    value = spent if kind == "PURCHASE" else price if kind == "PRICE_CHANGE" else revenue
    base = {"event_id": f"EVT{i:07d}", "event_timestamp": str(START + timedelta(hours=i)), "event_type": kind, "branch_id": "BR01", "city": "Karachi",
            "product_id": "P0001", "category": "Grocery", "supplier_id": "SUP001", "quantity": qty, "unit_cost": cost, "unit_price": price,
            "discount_pct": disc, "revenue": revenue, "purchase_cost": spent, "profit": round(revenue - spent, 2), "event_value": value,
            "return_reason": "Damaged" if kind == "RETURN" else None, "schema_version": 1}
    return {**base, **change}


def clean_stream():
    out = []
    for k in range(24):
        branch = f"BR0{1 + k % 2}"
        out.append(event(k, branch_id=branch, city=CITIES[branch], product_id=f"P000{1 + k // 8}", supplier_id=f"SUP00{1 + k // 8}",
                         quantity=1 + k % 5))
    return out


def raw(spark, events, topics=None):
    rows = []
    for offset, e in enumerate(events):
        text = e if isinstance(e, str) or e is None else json.dumps(e)
        kind = "SALE" if not isinstance(e, dict) else e.get("event_type")
        topic = (topics or {}).get(offset, "retail." + TOPIC_OF_TYPE.get(kind, "dead_letter"))
        rows.append((topic, 0, offset, START + timedelta(seconds=offset), "k", text))
    return spark.createDataFrame(rows, "topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp_ntz, key string, value string")


V = event(900)
FAULTS = {
    "missing_event_id": ({"event_id": None}, "MISSING_EVENT_ID"),
    "bad_event_id_format": ({"event_id": "X-1"}, "INVALID_EVENT_ID_FORMAT"),
    "unknown_event_type": ({"event_type": "REFUND"}, "INVALID_EVENT_TYPE"),
    "negative_quantity": ({"quantity": -3}, "INVALID_QUANTITY"),
    "zero_quantity": ({"quantity": 0}, "INVALID_QUANTITY"),
    "fractional_quantity": ({"quantity": 2.5}, "INVALID_QUANTITY"),
    "huge_quantity": ({"quantity": 99999999999}, "INVALID_QUANTITY"),
    "bad_branch_id": ({"branch_id": "BRANCH-7"}, "INVALID_BRANCH_ID"),
    "bad_product_id": ({"product_id": "PROD1"}, "INVALID_PRODUCT_ID"),
    "bad_supplier_id": ({"supplier_id": "S-9"}, "INVALID_SUPPLIER_ID"),
    "zero_unit_price": ({"unit_price": 0.0}, "INVALID_UNIT_PRICE"),
    "negative_unit_cost": ({"unit_cost": -12.5}, "INVALID_UNIT_COST"),
    "discount_over_100pct": ({"discount_pct": 1.4}, "INVALID_DISCOUNT"),
    "future_timestamp": ({"event_timestamp": "2099-01-01 00:00:00"}, "TIMESTAMP_OUT_OF_RANGE"),
    "unparseable_timestamp": ({"event_timestamp": "yesterday-ish"}, "INVALID_TIMESTAMP"),
    "revenue_mismatch": ({"revenue": V["revenue"] * 1.5 + 100}, "REVENUE_MISMATCH"),
    "purchase_cost_mismatch": ({"purchase_cost": V["purchase_cost"] * 0.5}, "PURCHASE_COST_MISMATCH"),
    "profit_mismatch": ({"profit": V["profit"] + 500}, "PROFIT_MISMATCH"),
    "missing_return_reason": ({"event_type": "RETURN", "return_reason": None}, "INVALID_RETURN_REASON"),
    "unknown_return_reason": ({"event_type": "RETURN", "return_reason": "Felt like it"}, "INVALID_RETURN_REASON"),
    "missing_city": ({"city": None}, "MISSING_REQUIRED_FIELD"),
    "blank_city": ({"city": "   "}, "MISSING_REQUIRED_FIELD"),
    "category_conflict": ({"category": "Imaginary Category"}, "PRODUCT_ATTRIBUTE_CONFLICT"),
    "city_conflict": ({"city": "Atlantis"}, "BRANCH_CITY_CONFLICT"),
}
assert len(RULES["severity"]) == 26
