import random
from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marginwatch.config import ANALYTICS, override
from marginwatch.functions import stats
from marginwatch.operators import detection, finance, scoring

LO, HI = date(2024, 10, 1), date(2026, 9, 30)
BRANCH_COLS = ["gross_margin", "discount_rate", "return_rate_units", "shrink_rate", "growth_rate"]
NO_ANOMALIES = "anomaly_id string, entity_type string, entity_id string, severity string"


# ------------------------------------------------------------------ order statistics
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6))), min_size=1, max_size=60))
def test_distributed_and_plain_ranks_agree_with_pandas(spark, values):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(values)], "id int, g string, v double").cache()
    pdf = df.toPandas().set_index("id")
    expected = pdf.groupby("g")["v"].transform(lambda s: pd.Series(0.5, s.index) if s.notna().sum() <= 1 else ((s.rank() - 1) / (s.notna().sum() - 1)).fillna(0.5))
    q = pdf.groupby("g")["v"].quantile(0.3)
    out = stats.with_pct_ranks(df, "id", {"r": ("v", True)}, ["g"])
    out = stats.with_quantiles(out, {"q": ("v", 0.3)}, ["g"]).toPandas().set_index("id")
    assert np.allclose(out["r"].sort_index(), expected.sort_index())
    assert np.allclose(out["q"].astype(float).sort_index(), out["g"].map(q).astype(float).sort_index(), equal_nan=True)
    df.unpersist()


def test_hot_value_and_one_big_group(spark):
    """A third of the rows share one value in one group holding nearly everything."""
    rng = random.Random(1)
    rows = [("hot", 0.0)] * 1000 + [("hot", rng.gauss(0, 1)) for _ in range(2000)] + [("cold", 1.0), ("cold", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.m) for r in stats.quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    hot = [v for g, v in rows if g == "hot"]
    assert got["cold"] == (2, 2.0) and got["hot"] == (3000, pytest.approx(np.median(hot)))
    placed = stats.order_stats(df, "v", ["g"])
    assert placed.agg({"ties": "sum"}).first()[0] == len(rows) and placed.where("less + ties > n").count() == 0


def test_ranks_of_a_value_that_most_rows_share(spark):
    """Nine tenths of the products have one velocity: its rows are dealt over pieces, and no exchange has the value as key."""
    rng = random.Random(3)
    rows = [(f"P{i:05d}", "ab"[i % 7 == 0], 0.0 if rng.random() < 0.9 else rng.gauss(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "product_id string, category string, v double").repartition(5)
    long = stats.with_positions(df, "product_id", "v", ["category"])
    got = {r.product_id: (r.less, r.ties, r.n) for r in long.collect()}
    pdf = df.toPandas().set_index("product_id")
    g = pdf.groupby("category")["v"]
    want = pd.DataFrame({"less": g.rank(method="min") - 1, "ties": pdf.groupby(["category", "v"])["v"].transform("size"), "n": g.transform("size")})
    assert got == {k: (int(r.less), int(r.ties), int(r.n)) for k, r in want.iterrows()}
    plan = long._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert keyed and not any("_v#" in line.split("hashpartitioning")[1].split("ENSURE")[0] for line in keyed)


@pytest.mark.parametrize("kind", ["linear", "index"])
def test_selection_of_ranks_in_large_and_small_groups(spark, monkeypatch, kind):
    """With coarse cuts, so that brackets are real: some values are inside, most are counted outside."""
    monkeypatch.setattr(stats, "ACCURACY", 100)
    rng = random.Random(8)
    rows = [("big", rng.gauss(0, 1)) for _ in range(4000)] + [("hot", float(rng.random() < 0.3)) for _ in range(3000)] + [(f"s{k}", float(rng.randrange(9))) for k in range(1, 12) for _ in range(k)] + [("big", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = {"a": 0.05, "m": 0.5, "z": 0.95, "lo": 0.0, "hi": 1.0}
    got = {r.g: r for r in stats.quantiles(df, "v", probs, ["g"], kind).collect()}
    for g in {g for g, _ in rows}:
        v = sorted(x for h, x in rows if h == g and x is not None)
        assert got[g].n == len(v)
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(v, p) if kind == "linear" else v[min(int(p * len(v)), len(v) - 1)]), (g, name)
    whole = stats.quantiles(df, "v", {"m": 0.5}, kind=kind).first()
    v = sorted(x for _, x in rows if x is not None)
    assert whole.n == len(v) and whole.m == pytest.approx(np.median(v) if kind == "linear" else v[len(v) // 2])


def test_percentile_rank_nulls_and_direction(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.3), (3, 0.2), (4, None)], "id int, v double")
    rows = {r.id: (r.up, r.down) for r in stats.with_pct_ranks(df, "id", {"up": ("v", True), "down": ("v", False)}).collect()}
    assert rows == {1: (0.0, 1.0), 2: (1.0, 0.0), 3: (0.5, 0.5), 4: (0.5, 0.5)}


# ------------------------------------------------------------------ peer detection
def branches(spark, outlier=None, rate=0.22, sales=13000, jitter=0.002):
    rng = random.Random(5)
    rows = [(f"BR{i + 1:02d}", f"City{i}", rate if i == outlier else 0.062 + rng.uniform(-jitter, jitter), sales, 1e8, 9e7) for i in range(15)]
    return spark.createDataFrame(rows, "branch_id string, city string, discount_rate double, sale_events int, gross_sales double, net_revenue double")


def peer(spark, df, check=0, **changes):
    c = {**ANALYTICS["anomaly"]["peer_checks"][check], **changes}
    cfg = {**ANALYTICS, "anomaly": {**ANALYTICS["anomaly"], "peer_checks": [c]}}
    return detection.detect_peer({"branch": df}, cfg, LO, HI).collect()


@pytest.mark.parametrize("where", [6, 2])
def test_outlier_is_found_where_it_is(spark, where):
    found = peer(spark, branches(spark, where))
    assert [f.entity_id for f in found] == [f"BR{where + 1:02d}"]
    f = found[0]
    assert f.severity == "critical" and f.entity_label == f"BR{where + 1:02d} (City{where})" and f.leakage_type == "EXCESS_DISCOUNT"
    gap, years = f.observed_value - f.baseline_value, (HI - LO).days / 365
    assert float(f.estimated_exposure) == pytest.approx(gap * 1e8, abs=0.01) and float(f.annualised_exposure) == pytest.approx(gap * 1e8 / years, abs=0.02)
    assert f.explanation.startswith(f"{f.entity_label}, discount rate: 22.0 %. The middle of 15 branches is {f.baseline_value * 100:.1f} %. It lies {gap * 100:.1f} points above that") and "Seen in 13,000 sales." in f.explanation


def test_no_outlier_small_gap_or_small_sample_is_silent(spark):
    assert peer(spark, branches(spark)) == []
    assert peer(spark, branches(spark, 3, rate=0.075)) == []
    assert peer(spark, branches(spark, 3, sales=50)) == []
    assert peer(spark, branches(spark, 0).limit(4)) == []


def test_low_direction(spark):
    found = peer(spark, branches(spark, 1, rate=0.01), direction="low")
    assert [f.entity_id for f in found] == ["BR02"] and " below that" in found[0].explanation


def test_baseline_floor_and_severity_edges(spark):
    zero = spark.createDataFrame([("c", 0.0)] * 10, "check_id string, v double")
    assert stats.with_baseline(zero, "v", "0.005D", ["check_id"]).select("median", "scale", "peers").first() == (0.0, 0.005, 10)
    z = spark.createDataFrame([(3.4,), (3.5,), (6.0,), (10.0,)], "z double").selectExpr(f"{detection.severity('z', '3.5', '6', '10')} as s")
    assert [r.s for r in z.collect()] == [None, "medium", "high", "critical"]


# ------------------------------------------------------------------ temporal detection
def series(spark, months, shift_at=None):
    rng = random.Random(9)
    rows = [("BR01", f"{2024 + (9 + i) // 12}-{(9 + i) % 12 + 1:02d}", 0.06 + rng.gauss(0, 0.003) + (0.08 if shift_at is not None and i >= shift_at else 0), 0.1, 0.2)
            for i in range(months)]
    return spark.createDataFrame(rows, "branch_id string, year_month string, discount_rate double, return_rate_units double, gross_margin double")


def test_temporal_shift(spark):
    found = detection.detect_temporal({"branch": series(spark, 24, 21)}, ANALYTICS, HI).collect()
    assert [f.anomaly_id for f in found] == ["branch_discount_shift:BR01"]
    assert found[0].sample_size == 24 and found[0].estimated_exposure is None and " of the 12 before." in found[0].explanation
    assert detection.detect_temporal({"branch": series(spark, 24)}, ANALYTICS, HI).count() == 0
    assert detection.detect_temporal({"branch": series(spark, 8, 5)}, ANALYTICS, HI).count() == 0


# ------------------------------------------------------------------ scoring
def test_branch_scores(spark):
    rows = [("A", "x", .30, .05, .09, .05, .05), ("B", "x", .24, .06, .10, .06, 0.0), ("C", "x", .24, .07, .10, .06, -.01), ("D", "x", .20, .22, .11, .10, -.10)]
    base = spark.createDataFrame(rows, "branch_id string, city string, " + ", ".join(f"{c} double" for c in BRANCH_COLS))
    out = {r.branch_id: r for r in scoring.score_branches(base, spark.createDataFrame([], NO_ANOMALIES), ANALYTICS).collect()}
    assert out["D"].score_discount_rate == 0.0 and (out["A"].performance_rank, out["A"].performance_band) == (1, "strong")
    assert (out["D"].performance_rank, out["D"].performance_band, out["D"].operational_risk) == (4, "weak", "low")
    assert all(0 <= r.performance_score <= 100 for r in out.values())


def test_product_flags(spark):
    rows = [(f"P{i:04d}", "G", 200, 0.05 + 0.35 * i / 39, 0.06, 0.30 if i == 0 else 0.02, -0.40 if i == 0 else 0.1, 1000.0) for i in range(40)]
    rows.append(("P9999", "G", 10, 0.01, 0.9, 0.9, -0.9, 10.0))
    base = spark.createDataFrame(rows, "product_id string, category string, sale_events int, gross_margin double, discount_rate double, return_rate_units double, "
                                       "growth_rate double, net_revenue double")
    out = {r.product_id: r for r in scoring.flag_products(base, spark.createDataFrame([], NO_ANOMALIES), ANALYTICS).collect()}
    p = out["P0000"]
    assert p.is_low_margin and p.is_high_return and p.is_declining and p.is_problematic
    assert p.problem_reasons.startswith("margin 5.0 %, among the lowest in G; returns 30.0 %") and "revenue down by 40 %" in p.problem_reasons
    q = out["P9999"]
    assert not (q.is_low_margin or q.is_high_return or q.is_high_discount or q.is_declining or q.is_problematic) and q.problem_reasons is None


def test_inventory_scores(spark):
    rows = [(f"P{i}", "G", 0.1 + 0.1 * i, 0.9 - 0.85 * i / 29, 400 if i == 3 else (None if i == 4 else 1), 5 + int(195 * i / 29)) for i in range(30)]
    base = spark.createDataFrame(rows, "product_id string, category string, velocity_per_day double, replenishment_ratio double, days_since_last_sale int, "
                                       "days_since_last_purchase int")
    out = {r.product_id: r for r in scoring.score_inventory(base, ANALYTICS).collect()}
    assert (out["P29"].stockout_risk_score, out["P29"].stockout_risk_level, out["P29"].reorder_flag) == (100.0, "high", True)
    assert (out["P0"].stockout_risk_score, out["P0"].stockout_risk_level, out["P0"].is_slow_moving) == (0.0, "normal", True)
    assert out["P3"].is_dead_stock and out["P4"].is_dead_stock and not out["P5"].is_dead_stock
    assert out["P29"].explanation.startswith("90 days of sales: 3.0 units a day, ahead of 100 % of the products. Purchases made up for 5 % of")


# ------------------------------------------------------------------ leakage and KPIs
def test_leakage_sums_per_type_and_keeps_opportunity_apart(spark):
    rows = [("a1", "PEER", "branch_discount_rate", "branch", "BR07", "BR07 (X)", "high", 100.0, None),
            ("a2", "PEER", "branch_adjustment_qty", "branch", "BR12", "BR12 (Y)", "high", 300000.0, "INVENTORY_DISCREPANCY"),
            ("a3", "PEER", "branch_damage_rate", "branch", "BR12", "BR12 (Y)", "high", 200000.0, "INVENTORY_DISCREPANCY"),
            ("a4", "TEMPORAL", "branch_discount_shift", "branch", "BR12", "BR12 (Y)", "high", None, None)]
    anomalies = spark.createDataFrame(rows, "anomaly_id string, detection_method string, check_id string, entity_type string, entity_id string, entity_label string, "
                                            "severity string, estimated_exposure double, leakage_type string")
    products = spark.createDataFrame([("P1", "G", .30, 2000.0, False), ("P2", "G", .30, 2000.0, False), ("P3", "G", .10, 2000.0, True)],
                                     "product_id string, category string, gross_margin double, net_revenue double, is_low_margin boolean")
    out = {r.leakage_type: r for r in finance.leakage(anomalies, products, ANALYTICS, LO, HI).collect()}
    assert set(out) == {"INVENTORY_DISCREPANCY", "LOW_MARGIN_SHORTFALL"}
    assert (out["INVENTORY_DISCREPANCY"].exposure_amount, out["INVENTORY_DISCREPANCY"].source_anomaly_id) == (500000, "a2;a3")
    assert out["LOW_MARGIN_SHORTFALL"].exposure_amount == 400 and out["LOW_MARGIN_SHORTFALL"].basis == finance.LEAKAGE_BASIS["LOW_MARGIN_SHORTFALL"]


def test_kpis(spark):
    months = [f"{2024 + i // 12}-{i % 12 + 1:02d}" for i in range(24)]
    cols = ["net_revenue", "gross_profit", "units_sold", "gross_sales", "discount_amount", "return_units", "return_value", "return_profit_impact", "damage_value",
            "adjustment_value", "purchase_spend", "price_variance_amount", "adjusted_gross_profit"]
    company = spark.createDataFrame([(m, 100.0, 25.0, *[10.0] * 11) for m in months], "year_month string, " + ", ".join(f"{c} double" for c in cols))
    leak = spark.createDataFrame([("EXCESS_RETURNS", 10.0, 5.0), ("LOW_MARGIN_SHORTFALL", 99.0, 50.0)], "leakage_type string, exposure_amount double, annualised_exposure double")
    flags = spark.createDataFrame([("weak", True, "high", True, True, True, "low", "critical")],
                                  "performance_band string, is_problematic boolean, stockout_risk_level string, is_slow_moving boolean, is_dead_stock boolean, "
                                  "reorder_flag boolean, risk_level string, severity string")
    out = {r.kpi_key: r for r in finance.kpis(company, flags, flags, flags, flags, flags, leak, LO, HI).collect()}
    assert len(out) == 33 and out["net_revenue"].value_numeric == 2400 and out["gross_margin"].value_numeric == 0.25
    assert out["net_revenue_12m"].value_numeric == 1200 and out["revenue_growth_yoy"].value_numeric == 0
    assert out["leakage_total"].value_numeric == 10 and out["margin_opportunity"].value_numeric == 99
    assert out["as_of_date"].value_text == "2026-09-30" and out["suppliers_at_risk"].value_numeric == 0
