"""Sentences for findings, as SQL expression text over named columns."""
from __future__ import annotations

# How each metric is named, and the unit it is shown in.
METRICS = {
    "discount_rate": ("discount rate", "pct"),
    "return_rate_units": ("return rate", "pct"),
    "adjustment_avg_qty": ("average stock-adjustment size", "units"),
    "damage_rate": ("damage rate", "pct"),
    "gross_margin": ("gross margin", "pct"),
    "ppv_pct": ("purchase cost versus standard cost", "pct_signed"),
}
# Of each unit: factor, what follows a value, what follows a difference, whether a value shows its sign.
UNITS = {
    "pct": (100, " %", " points", False),
    "pct_signed": (100, " %", " points", True),
    "units": (1, " units", " units", False),
}
PEER_NOUN = {"branch": "branches", "product": "products", "supplier": "suppliers"}
UNIT_NOUN = {"sale_events": "sales", "adjustment_events": "stock adjustments", "purchase_events": "purchases"}


def label(key: str, detail: str | None) -> str:
    """`BR07 (Lahore)`, `P0001 (Grocery)`; the bare id where there is no detail."""
    return key if detail is None else f"coalesce(concat({key}, ' (', {detail}, ')'), {key})"


def metric(name: str) -> tuple[str, str]:
    """Label and unit of a metric; a metric without an entry is a number under its own name."""
    return METRICS.get(name, (name, "number"))


def number(v: str, digits: int = 1) -> str:
    """SQL: a number as text, rounded half up to a fixed number of digits."""
    return f"string(cast(round({v}, {digits}) as decimal(38,{digits})))"


def grouped(v: str) -> str:
    """SQL: a whole number as text, thousands set apart by commas."""
    return f"format_number(round({v}, 0), 0)"


def _by_unit(v: str, after: int, signed: bool) -> str:
    """SQL: a number in the unit that the column `kind` names."""
    known = []
    for unit, spec in UNITS.items():
        sign = f"if({v} >= 0, '+', ''), " if signed and spec[3] else ""
        known.append(f"when '{unit}' then concat({sign}{number(f'{v} * {spec[0]}D')}, '{spec[after]}')")
    return f"case kind {' '.join(known)} else {number(v, 2)} end"


def value_text(v: str) -> str:
    return _by_unit(v, 1, True)


def gap_text() -> str:
    return f"concat({_by_unit('gap', 2, False)}, if(direction = 'high', ' above', ' below'))"


def explain_peer(currency: str) -> str:
    """Over: entity_label, metric_label, kind, direction, value, median, gap, z, severity, n, n_noun,
    peers, peer_noun, estimated_exposure, annualised_exposure, years."""
    what = f"concat(entity_label, ', ', metric_label, ': ', {value_text('value')}, '. The middle of ', string(peers), ' ', peer_noun, ' is ', {value_text('median')}, '.')"
    how_far = f"concat('It lies ', {gap_text()}, ' that, or ', {number('z')}, ' robust deviations: ', severity, '.')"
    sample = f"concat('Seen in ', {grouped('n')}, ' ', n_noun, '.')"
    yearly = f"if(annualised_exposure <> 0, concat(', {currency} ', {grouped('annualised_exposure')}, ' in a year'), '')"
    cost = f"case when estimated_exposure > 0 then concat('At stake: {currency} ', {grouped('estimated_exposure')}, ' in ', {number('years')}, ' years', {yearly}, '.') end"
    return f"concat_ws(' ', {what}, {how_far}, {sample}, {cost})"


def explain_temporal(recent_months: int) -> str:
    """Over: entity_label, metric_label, kind, direction, recent, base_mean, spread, gap, z, severity, baseline_months."""
    return (f"concat(entity_label, ', ', metric_label, ': ', {value_text('recent')}, ' as the mean of its latest {recent_months} months, ', {gap_text()}, ' the ', "
            f"{value_text('base_mean')}, ' of the ', string(baseline_months), ' before. One month differs from the next by about ', {value_text('spread')}, "
            f"'; the shift has a z of ', {number('z')}, ': ', severity, '.')")


def explain_stockout(velocity_days: int, window_days: int) -> str:
    """Over: velocity_per_day, pct_velocity, replenishment_ratio, days_since_last_purchase. A sentence
    for each that is known."""
    pace = f"concat('{velocity_days} days of sales: ', {number('velocity_per_day')}, ' units a day, ahead of ', {number('pct_velocity * 100', 0)}, ' % of the products.')"
    cover = f"concat('Purchases made up for ', {number('replenishment_ratio * 100', 0)}, ' % of what {window_days} days sold.')"
    last = "concat('Bought last ', string(days_since_last_purchase), ' days ago.')"
    return f"coalesce(nullif(concat_ws(' ', {pace}, {cover}, {last}), ''), 'No movement to judge by.')"
