"""Default parameters. Every operator takes its configuration as a plain dict, so a
caller overrides by copying one of these and changing it (see `override`)."""
from __future__ import annotations

import copy

# ---------------------------------------------------------------- fixed values
# Contract vocabulary: field order, event types, reasons, routing.
EVENT_FIELDS = [
    "event_id", "event_timestamp", "event_type", "branch_id", "city", "product_id", "category",
    "supplier_id", "quantity", "unit_cost", "unit_price", "discount_pct", "revenue",
    "purchase_cost", "profit", "event_value", "return_reason",
]
REQUIRED_FIELDS = [
    "event_timestamp", "branch_id", "city", "product_id", "category", "supplier_id", "quantity",
    "unit_cost", "unit_price", "discount_pct", "revenue", "purchase_cost", "profit", "event_value",
]
SCHEMA_VERSION = 1
TOPIC_OF_TYPE = {
    "SALE": "sales",
    "PURCHASE": "purchases",
    "RETURN": "returns",
    "STOCK_ADJUSTMENT": "inventory",
    "DAMAGE": "inventory",
    "PRICE_CHANGE": "price_changes",
}
DEAD_LETTER = "dead_letter"
FACT_OF_TYPE = {
    "SALE": "fact_sales",
    "PURCHASE": "fact_purchases",
    "RETURN": "fact_returns",
    "STOCK_ADJUSTMENT": "fact_inventory_movements",
    "DAMAGE": "fact_inventory_movements",
    "PRICE_CHANGE": "fact_price_changes",
}

RULES = {
    "event_types": ["SALE", "PURCHASE", "RETURN", "STOCK_ADJUSTMENT", "DAMAGE", "PRICE_CHANGE"],
    "return_reasons": ["Customer Changed Mind", "Damaged", "Other", "Quality Issue", "Wrong Item"],
    "id_patterns": {
        "event_id": "^EVT[0-9]{7}$",
        "branch_id": "^BR[0-9]{2}$",
        "product_id": "^P[0-9]{4}$",
        "supplier_id": "^SUP[0-9]{3}$",
    },
    "timestamp": {"earliest": "2020-01-01", "future_tolerance_days": 1},
    "limits": {"quantity_max": 10000, "discount_max": 0.95, "unit_price_max": 10000000},
    "financial": {"abs_tolerance": 0.02, "rel_tolerance": 0.0005, "per_unit_tolerance": 0.0051},
    "dimension_consistency": {"min_agreement": 0.5},
    "severity": {
        "MALFORMED_PAYLOAD": "REJECT",
        "MISSING_EVENT_ID": "REJECT",
        "INVALID_EVENT_ID_FORMAT": "REJECT",
        "DUPLICATE_EVENT_ID": "REJECT",
        "INVALID_EVENT_TYPE": "REJECT",
        "MISSING_REQUIRED_FIELD": "REJECT",
        "INVALID_TIMESTAMP": "REJECT",
        "TIMESTAMP_OUT_OF_RANGE": "REJECT",
        "INVALID_BRANCH_ID": "REJECT",
        "INVALID_PRODUCT_ID": "REJECT",
        "INVALID_SUPPLIER_ID": "REJECT",
        "INVALID_QUANTITY": "REJECT",
        "INVALID_UNIT_COST": "REJECT",
        "INVALID_UNIT_PRICE": "REJECT",
        "INVALID_DISCOUNT": "REJECT",
        "INVALID_RETURN_REASON": "REJECT",
        "PURCHASE_COST_MISMATCH": "REJECT",
        "REVENUE_MISMATCH": "REJECT",
        "PROFIT_MISMATCH": "REJECT",
        "EVENT_VALUE_MISMATCH": "REJECT",
        "PRODUCT_ATTRIBUTE_CONFLICT": "REJECT",
        "BRANCH_CITY_CONFLICT": "REJECT",
        "TOPIC_ROUTE_MISMATCH": "WARN",
        "UNEXPECTED_RETURN_REASON": "WARN",
        "NEGATIVE_LIST_MARGIN": "WARN",
        "POSSIBLE_DUPLICATE_BUSINESS_KEY": "WARN",
    },
}

ANALYTICS = {
    "currency": "PKR",
    "as_of_date": None,
    "windows": {
        "velocity_days": 90,
        "replenishment_days": 180,
        "growth_months": 6,
        "temporal_recent_months": 3,
        "temporal_baseline_months": 12,
    },
    "returns": {"non_restockable_reasons": ["Damaged", "Quality Issue"]},
    "anomaly": {
        "severity_z": {"medium": 3.5, "high": 6.0, "critical": 10.0},
        "peer_checks": [
            {"id": "branch_discount_rate", "entity": "branch", "metric": "discount_rate", "direction": "high",
             "min_scale": 0.005, "min_abs_effect": 0.02, "min_n": 200, "n_col": "sale_events",
             "exposure_base": "gross_sales", "leakage_type": "EXCESS_DISCOUNT"},
            {"id": "branch_return_rate", "entity": "branch", "metric": "return_rate_units", "direction": "high",
             "min_scale": 0.005, "min_abs_effect": 0.02, "min_n": 200, "n_col": "sale_events",
             "exposure_base": "net_revenue", "leakage_type": "EXCESS_RETURNS"},
            {"id": "branch_adjustment_qty", "entity": "branch", "metric": "adjustment_avg_qty", "direction": "high",
             "min_scale": 0.25, "min_abs_effect": 2.0, "min_n": 50, "n_col": "adjustment_events",
             "exposure_base": "adjustment_event_cost", "leakage_type": "INVENTORY_DISCREPANCY"},
            {"id": "branch_damage_rate", "entity": "branch", "metric": "damage_rate", "direction": "high",
             "min_scale": 0.003, "min_abs_effect": 0.01, "min_n": 200, "n_col": "sale_events",
             "exposure_base": "cogs", "leakage_type": "INVENTORY_DISCREPANCY"},
            {"id": "branch_margin", "entity": "branch", "metric": "gross_margin", "direction": "low",
             "min_scale": 0.005, "min_abs_effect": 0.02, "min_n": 200, "n_col": "sale_events",
             "exposure_base": "net_revenue", "leakage_type": None},
            {"id": "product_return_rate", "entity": "product", "metric": "return_rate_units", "direction": "high",
             "min_scale": 0.01, "min_abs_effect": 0.05, "min_n": 100, "n_col": "sale_events",
             "exposure_base": "net_revenue", "leakage_type": "EXCESS_RETURNS",
             "severity_z": {"medium": 4.5, "high": 7.0, "critical": 10.0}},
            {"id": "product_discount_rate", "entity": "product", "metric": "discount_rate", "direction": "high",
             "min_scale": 0.005, "min_abs_effect": 0.03, "min_n": 100, "n_col": "sale_events",
             "exposure_base": "gross_sales", "leakage_type": "EXCESS_DISCOUNT",
             "severity_z": {"medium": 4.5, "high": 7.0, "critical": 10.0}},
            {"id": "supplier_price_variance", "entity": "supplier", "metric": "ppv_pct", "direction": "high",
             "min_scale": 0.005, "min_abs_effect": 0.02, "min_n": 20, "n_col": "purchase_events",
             "exposure_base": "purchase_standard_spend", "leakage_type": "PROCUREMENT_OVERPAYMENT"},
        ],
        "temporal_checks": [
            {"id": "branch_discount_shift", "entity": "branch", "metric": "discount_rate", "direction": "high",
             "min_abs_effect": 0.02, "min_std": 0.005, "z_threshold": 4.0},
            {"id": "branch_return_shift", "entity": "branch", "metric": "return_rate_units", "direction": "high",
             "min_abs_effect": 0.02, "min_std": 0.01, "z_threshold": 4.0},
            {"id": "branch_margin_shift", "entity": "branch", "metric": "gross_margin", "direction": "low",
             "min_abs_effect": 0.02, "min_std": 0.005, "z_threshold": 4.0},
            {"id": "supplier_cost_shift", "entity": "supplier", "metric": "ppv_pct", "direction": "high",
             "min_abs_effect": 0.02, "min_std": 0.005, "z_threshold": 4.0},
        ],
    },
    "branch_score": {
        "z_cap": 3.0,
        "components": {
            "gross_margin": {"weight": 0.25, "higher_is_better": True, "min_scale": 0.005, "out": "score_gross_margin"},
            "discount_rate": {"weight": 0.25, "higher_is_better": False, "min_scale": 0.005, "out": "score_discount_rate"},
            "return_rate_units": {"weight": 0.15, "higher_is_better": False, "min_scale": 0.005, "out": "score_return_rate"},
            "shrink_rate": {"weight": 0.15, "higher_is_better": False, "min_scale": 0.01, "out": "score_shrink_rate"},
            "growth_rate": {"weight": 0.20, "higher_is_better": True, "min_scale": 0.02, "out": "score_growth_rate"},
        },
        "bands": {"strong": 45, "watch": 30},
    },
    "inventory": {
        "slow_moving_percentile": 20,
        "dead_stock_days_no_sale": 60,
        "reorder_min_days_since_purchase": 45,
        "stockout_proxy": {
            "weights": {"velocity": 0.35, "replenishment_gap": 0.40, "purchase_recency": 0.25},
            "bands": {"high": 75, "elevated": 55},
        },
    },
    "product": {
        "min_sale_events": 50,
        "high_margin_percentile": 90,
        "low_margin_percentile": 10,
        "declining_growth_threshold": -0.15,
    },
}


def override(base: dict, **changes) -> dict:
    """Deep copy of `base` with nested changes: keys are dotted paths written with `__`."""
    out = copy.deepcopy(base)
    for path, value in changes.items():
        node = out
        *parents, leaf = path.split("__")
        for p in parents:
            node = node[p]
        node[leaf] = value
    return out


def check_config(analytics: dict, rules: dict, rule_codes: list[str]) -> None:
    """Fail early on a weight set that does not sum to 1 or a rule without a severity."""
    for name, weights in {
        "branch_score": [c["weight"] for c in analytics["branch_score"]["components"].values()],
        "stockout_proxy": list(analytics["inventory"]["stockout_proxy"]["weights"].values()),
    }.items():
        if abs(sum(weights) - 1.0) > 1e-9:
            raise ValueError(f"{name} weights sum to {sum(weights)}, not 1")
    missing = sorted(set(rule_codes) - set(rules["severity"]))
    if missing:
        raise ValueError(f"rules without a severity: {missing}")
