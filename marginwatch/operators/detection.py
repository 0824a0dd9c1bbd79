"""Outlier checks over entity and monthly tables.

All peer checks run as one long table (check, entity, value, sample, base), so the medians of
every check come from the same shuffle; the same holds for the temporal checks. A new check is
a new configuration entry.
"""
from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.stats import with_baseline

ID = {"branch": "branch_id", "product": "product_id", "supplier": "supplier_id"}
LABEL_DETAIL = {"branch": "city", "product": "category", "supplier": None}
MIN_PEERS = 5
SEVERITIES = ["medium", "high", "critical"]      # fixed order, mildest first

ANOMALY_COLUMNS = {
    "anomaly_id": "string", "as_of_date": "date", "detection_method": "string", "check_id": "string",
    "entity_type": "string", "entity_id": "string", "entity_label": "string", "metric": "string",
    "direction": "string", "observed_value": "double", "baseline_value": "double", "baseline_spread": "double",
    "robust_z": "double", "severity": "string", "sample_size": "bigint", "estimated_exposure": "decimal(28,2)",
    "annualised_exposure": "decimal(28,2)", "leakage_type": "string", "period_start": "date", "period_end": "date",
    "explanation": "string", "evidence": "string",
}


def severity(z: str, medium: str, high: str, critical: str) -> str:
    """Inclusive thresholds; null below the lowest."""
    return f"case when {z} >= {critical} then 'critical' when {z} >= {high} then 'high' when {z} >= {medium} then 'medium' end"


def years(period_start: date, period_end: date) -> float:
    return max((period_end - period_start).days, 1) / 365.0


def _struct(values: dict[str, object]) -> str:
    def lit(v: object) -> str:
        return "cast(null as string)" if v is None else f"{float(v)}D" if isinstance(v, (int, float)) else f"'{v}'"
    return ", ".join(f"'{k}', {lit(v)}" for k, v in values.items())


def _long(df: DataFrame, entity: str, keep: list[str], items: list[str]) -> DataFrame:
    detail = LABEL_DETAIL[entity] if LABEL_DETAIL[entity] in df.columns else None
    return df.selectExpr(f"'{entity}' as entity_type", f"{ID[entity]} as entity_id",
                         f"{text.label(ID[entity], detail)} as entity_label", *keep,
                         f"inline(array({', '.join(f'named_struct({i})' for i in items)}))")


def _conform(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*[f"cast({columns.get(c, c)} as {t}) as {c}" for c, t in ANOMALY_COLUMNS.items()])


# ------------------------------------------------------------------ peer comparison
def peer_candidates(features: dict[str, DataFrame], cfg: dict) -> DataFrame:
    """Eligible (check, entity) pairs: metric present and sample at least min_n."""
    parts = []
    for entity, df in features.items():
        items = []
        for c in (c for c in cfg["anomaly"]["peer_checks"] if c["entity"] == entity):
            z = c.get("severity_z", cfg["anomaly"]["severity_z"])
            base = c.get("exposure_base")
            items.append(_struct({
                "check_id": c["id"], "metric": c["metric"], "direction": c["direction"], "leakage_type": c.get("leakage_type"),
                "metric_label": text.metric(c["metric"])[0], "kind": text.metric(c["metric"])[1],
                "n_noun": text.UNIT_NOUN.get(c["n_col"], "events"), "peer_noun": text.PEER_NOUN[entity], "exposure_column": base,
                "min_scale": c["min_scale"], "min_abs_effect": c["min_abs_effect"], "min_n": c["min_n"],
                "z_medium": z["medium"], "z_high": z["high"], "z_critical": z["critical"]})
                + f", 'value', double({c['metric']}), 'n', bigint({c['n_col']}), "
                + f"'base', {f'double({base})' if base in df.columns else 'cast(null as double)'}")
        if items:
            parts.append(_long(df, entity, [], items))
    return reduce(DataFrame.unionByName, parts).where("value is not null and n >= min_n")


def peer_points(features: dict[str, DataFrame], cfg: dict) -> DataFrame:
    """Every eligible peer of every check with the check's median, scale and number of peers."""
    return with_baseline(peer_candidates(features, cfg), "value", "min_scale", ["check_id"])


def detect_peer(features: dict[str, DataFrame], cfg: dict, period_start: date, day: date) -> DataFrame:
    """Entities whose oriented gap to the peer median is both many robust deviations and large
    enough to matter, with the money at stake. Fewer than five peers give no baseline."""
    span = years(period_start, day)
    found = (peer_points(features, cfg).where(f"peers >= {MIN_PEERS}")
             .selectExpr("*", "case direction when 'high' then value - median else median - value end as gap")
             .selectExpr("*", "gap / scale as z")
             .selectExpr("*", f"{severity('z', 'z_medium', 'z_high', 'z_critical')} as severity")
             .where("severity is not null and gap >= min_abs_effect")
             .selectExpr("*", "round(gap * base, 2) as estimated_exposure", f"{span!r}D as years")
             .selectExpr("*", "round(estimated_exposure / years, 2) as annualised_exposure"))
    evidence = ("to_json(struct(median as peer_median, scale as peer_scale, peers, gap, exposure_column as exposure_base_column, "
                "base as exposure_base), map('ignoreNullFields', 'false'))")
    return _conform(found, anomaly_id="concat(check_id, ':', entity_id)", as_of_date=f"date'{day}'", detection_method="'PEER'",
                    observed_value="value", baseline_value="median", baseline_spread="scale", robust_z="round(z, 2)", sample_size="n",
                    period_start=f"date'{period_start}'", period_end=f"date'{day}'", explanation=text.explain_peer(cfg["currency"]),
                    evidence=evidence)


# ------------------------------------------------------------------ change against own history
def detect_temporal(monthly: dict[str, DataFrame], cfg: dict, day: date, labels: DataFrame | None = None) -> DataFrame:
    """Mean of an entity's last `recent` recorded months against the `baseline` months before
    them (positions in its own series, gaps are not filled). `labels` (entity_type, entity_id,
    label) names entities; the id is used where it has none."""
    w = cfg["windows"]
    recent, base = w["temporal_recent_months"], w["temporal_baseline_months"]
    parts = []
    for entity, df in monthly.items():
        items = [_struct({"check_id": c["id"], "metric": c["metric"], "direction": c["direction"],
                          "metric_label": text.metric(c["metric"])[0],
                          "kind": text.metric(c["metric"])[1], "min_abs_effect": c["min_abs_effect"],
                          "min_std": c["min_std"], "z_threshold": c["z_threshold"]}) + f", 'value', double({c['metric']})"
                 for c in cfg["anomaly"]["temporal_checks"] if c["entity"] == entity]
        if items:
            parts.append(_long(df, entity, ["year_month"], items))
    keys = ["check_id", "entity_type", "entity_id"]
    # One row per month and entity, so a window partition is as long as the calendar.
    ranked = (reduce(DataFrame.unionByName, parts).where("value is not null")
              .selectExpr("*", f"row_number() over (partition by {', '.join(keys)} order by year_month desc) as rn"))
    before = f"rn > {recent} and rn <= {recent + base}"
    fixed = ["metric", "direction", "metric_label", "kind", "min_abs_effect", "min_std", "z_threshold"]
    stats = ranked.groupBy(*keys).agg(*map(F.expr, [
        "count(1) as n", f"avg(case when rn <= {recent} then value end) as recent",
        f"avg(case when {before} then value end) as base_mean",
        f"coalesce(stddev_samp(case when {before} then value end), 0D) as base_std",
        f"count_if({before}) as baseline_months", *[f"first({c}) as {c}" for c in fixed]]))
    found = (stats.where(f"n >= {recent + max(6, base // 2)}")
             .selectExpr("*", "case direction when 'high' then recent - base_mean else base_mean - recent end as gap",
                         "greatest(base_std, min_std) as spread")
             .selectExpr("*", f"gap / (spread / sqrt({float(recent)}D)) as z")
             .where("z >= z_threshold and gap >= min_abs_effect")
             .selectExpr("*", f"{severity('z', 'z_threshold', '1.5D * z_threshold', '2.5D * z_threshold')} as severity"))
    if labels is not None:
        found = found.join(labels, ["entity_type", "entity_id"], "left")
    found = found.selectExpr("*", f"{'coalesce(label, entity_id)' if labels is not None else 'entity_id'} as entity_label")
    null = dict.fromkeys(["estimated_exposure", "annualised_exposure", "leakage_type", "period_start", "period_end"], "null")
    return _conform(found, anomaly_id="concat(check_id, ':', entity_id)", as_of_date=f"date'{day}'", detection_method="'TEMPORAL'",
                    observed_value="recent", baseline_value="base_mean", baseline_spread="spread", robust_z="round(z, 2)", sample_size="n",
                    explanation=text.explain_temporal(recent),
                    evidence=f"to_json(struct({recent} as recent_months, baseline_months, gap))", **null)


def branch_labels(branch: DataFrame) -> DataFrame:
    return branch.selectExpr("'branch' as entity_type", "branch_id as entity_id", f"{text.label('branch_id', 'city')} as label")


def detect_all(features: dict[str, DataFrame], cfg: dict, period_start: date, day: date) -> DataFrame:
    """Every configured check in one anomaly table. `features` holds the build_features tables."""
    peers = {e: features[f"{e}_base"] for e in ID}
    series = {"branch": features["branch_monthly"], "supplier": features["supplier_monthly"]}
    return detect_peer(peers, cfg, period_start, day).unionByName(
        detect_temporal(series, cfg, day, branch_labels(features["branch_base"])))


def anomaly_rollup(anomalies: DataFrame, entity_type: str) -> DataFrame:
    """entity_id, anomaly_count, max_anomaly_severity."""
    order = f"array_position(array({', '.join(repr(s) for s in SEVERITIES)}), severity)"
    return (anomalies.where(f"entity_type = '{entity_type}'").groupBy("entity_id")
            .agg(F.expr("count(1) as anomaly_count"), F.expr(f"max_by(severity, {order}) as max_anomaly_severity")))
