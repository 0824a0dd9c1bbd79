"""Exact order statistics, by ways that are the same whatever the size.

`quantiles` selects wanted ranks by refinement: one approximate cut of all groups, exact counts below it, and only
the values between two cuts are sorted. `with_positions` ranks rows in place, by counts of the pieces before
theirs. `order_stats` is the cumulative distribution of a column with one row per (group, distinct
value). Equal values collapse map-side first, then every group is cut at approximate quantiles
of all values into as many pieces as the session shuffles to, so a window task sees about that
share of the distinct values however large one group is. The cuts only spread the work: ranks,
medians and percentiles are exact, and interpolate by one formula.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pieces(df: DataFrame) -> int:
    """Pieces of a distribution: they follow the parallelism the session is set to."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _over(by: Sequence[str], order: str = "") -> str:
    part = f"partition by {', '.join(by)} " if by else ""
    return f"({part}{'order by ' + order if order else ''})"


# ------------------------------------------------------------------ distributed distribution
def order_stats(df: DataFrame, value: str, by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """by..., `value`, ties (rows holding it), less (rows of the group below it), n (rows of
    the group). Null values are left out; `by` columns must not be null."""
    by, buckets = list(by), buckets or _pieces(df)
    hist = (df.where(f"{value} is not null").selectExpr(*by, f"cast({value} as double) as {value}")
            .groupBy(*by, value).agg(F.expr("count(1) as ties")))
    marks = ", ".join(str(i / buckets) for i in range(1, buckets))
    cuts = hist.agg(F.expr(f"percentile_approx({value}, array({marks}), {100 * buckets})")).scalar()
    placed = (hist.withColumn("_cuts", cuts)
              .selectExpr(*by, value, "ties", f"coalesce(size(filter(_cuts, c -> c < {value})), 0) as _b"))
    # At most `buckets` rows per group from here on.
    offsets = placed.groupBy(*by, "_b").agg(F.expr("sum(ties) as _t")).selectExpr(
        *by, "_b", f"sum(_t) over {_over(by, '_b')} - _t as _before", f"sum(_t) over {_over(by)} as n")
    return placed.join(offsets, by + ["_b"]).selectExpr(
        *by, value, "ties", f"_before + sum(ties) over {_over([*by, '_b'], value)} - ties as less", "n")


# ------------------------------------------------------------------ selection of ranks
#: Accuracy of the approximate cuts, and their distances from a wanted share in units of its error.
ACCURACY, STEPS = 10_000, (2, 8)


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), kind: str = "linear") -> DataFrame:
    """One row per group: n and one column per name in `probs`. `linear` interpolates at p*(n-1), `index`
    takes the element floor(p*n), `first` the first one that p*n rows do not exceed. `by` columns must not be null.

    The first aggregation takes approximate cuts around every wanted share, whose error is bounded, the second
    counts what lies outside the cuts that must hold the wanted ranks and the distinct values inside. Those are
    some thousandths of a group (or all of a group of up to about a thousand values), which are then put in order."""
    by = list(by)
    rows = df.where(f"{value} is not null").selectExpr(*by, f"cast({value} as double) as _v")
    marks = sorted({min(1.0, max(0.0, p + sign * k / ACCURACY)) for p in probs.values() for k in STEPS for sign in (-1, 1)})
    cuts = rows.groupBy(*by).agg(*map(F.expr, ["count(1) as n", "min(_v) as _least", "max(_v) as _most",
                                               f"percentile_approx(_v, array({', '.join(f'{m!r}D' for m in marks)}), {ACCURACY}) as _cuts"]))

    def ends(p: float) -> tuple[str, str]:
        if kind == "linear":
            return f"floor({p!r}D * (n - 1))", f"ceil({p!r}D * (n - 1))"
        return (f"least(floor({p!r}D * n), n - 1)" if kind == "index" else f"greatest(ceil({p!r}D * n) - 1, 0)",) * 2

    bounds = []     # of each wanted share, two values that its ranks lie between for certain
    for p in probs.values():
        low, high = ends(float(p))
        below = " ".join(f"when {m!r}D + 1D / {ACCURACY} <= {low} / n then _cuts[{i}]" for i, m in reversed(list(enumerate(marks))))
        above = " ".join(f"when {m!r}D - 1D / {ACCURACY} >= ({high} + 1) / n then _cuts[{i}]" for i, m in enumerate(marks))
        bounds.append(f"named_struct('a', case {below} else _least end, 'b', case {above} else _most end)")
    cuts = cuts.selectExpr(*by, "n", f"array({', '.join(bounds)}) as _between")
    placed = rows.join(cuts, by) if by else rows.withColumn("_between", cuts.select("_between").scalar()).withColumn("n", cuts.select("n").scalar())
    placed = placed.selectExpr(*by, "n", "_v", "exists(_between, x -> _v >= x.a and _v <= x.b) as _in",
                               "aggregate(_between, 0, (s, x) -> s + int(_v >= x.a) + int(_v > x.b)) as _piece")
    counted = placed.groupBy(*by, "n", "_piece", F.expr("case when _in then _v end as _at")).agg(F.expr("min(_v) as _from"), F.expr("count(1) as _c"))
    lists = counted.groupBy(*by, "n").agg(F.expr("sort_array(collect_list(struct(_from, _at, _c))) as _l"))

    def at(rank: str) -> str:
        return f"aggregate(_l, named_struct('left', {rank} + 1, 'v', cast(null as double)), (s, x) -> named_struct('left', s.left - x._c, 'v', if(s.left > 0 and s.left <= x._c, x._at, s.v)), s -> s.v)"

    outs = []
    for name, p in probs.items():
        low, high = ends(float(p))
        outs.append(f"{at(low)} + ({at(high)} - {at(low)}) * ({p!r}D * (n - 1) - {low}) as {name}" if kind == "linear" else f"{at(low)} as {name}")
    return lists.selectExpr(*by, "n", *outs)


# ------------------------------------------------------------------ columns added to rows
def with_quantiles(df: DataFrame, specs: dict[str, tuple[str, float]], by: Sequence[str] = ()) -> DataFrame:
    """Add one column per spec (expression, p): the group's interpolated percentile on each row. Specs of
    one p share the passes."""
    by, out = list(by), df
    for p in dict.fromkeys(p for _, p in specs.values()):
        mine = {name: e for name, (e, q) in specs.items() if q == p}
        found = quantiles(melt(df, by, mine), "value", {"q": p}, ["component", *by])
        if by:
            wide = found.groupBy(*by).agg(*[F.expr(f"max(case when component = '{name}' then q end) as {name}") for name in mine])
            out = out.join(wide, by, "left")
        else:
            for name in mine:
                out = out.withColumn(name, found.where(F.col("component") == name).select("q").scalar())
    return out


def with_baseline(df: DataFrame, value: str, min_scale: str, by: Sequence[str]) -> DataFrame:
    """Add median, scale = max(1.4826 * MAD, min_scale) and peers of the row's group. `by` names
    configured things (checks, components), never data keys, so the medians that are broadcast
    below are one row per configuration entry. Rows must have a value."""
    by = list(by)
    med = quantiles(df.select(*by, value), value, {"median": 0.5}, by).withColumnRenamed("n", "peers")
    dev = df.select(*by, value).join(F.broadcast(med), by).selectExpr(*by, f"abs({value} - median) as _dev")
    mad = quantiles(dev, "_dev", {"_mad": 0.5}, by).drop("n")
    out = df.join(F.broadcast(med), by).join(F.broadcast(mad), by)
    return out.selectExpr("*", f"greatest(1.4826D * _mad, {min_scale}) as scale").drop("_mad")


def melt(df: DataFrame, ids: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """ids..., component, value: one row per (row, named expression), so several columns share a pass."""
    items = ", ".join(f"named_struct('component', '{k}', 'value', cast({e} as double))" for k, e in columns.items())
    return df.selectExpr(*ids, f"inline(array({items}))")


def with_positions(df: DataFrame, key: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Add less (rows of the group below the row's value), ties (rows that hold it) and n to rows that have a
    value. Rows are put into pieces by approximate cuts of all values and ranked inside; what the pieces before
    theirs hold is added from a table of a row for each piece and group. Nothing is keyed by the value:
    rows of a value that fills several pieces are dealt among them by `key`, and its counts, of which there
    are no more than pieces, come with that table."""
    by, pieces = list(by), _pieces(df)
    rows = df.withColumn("_v", F.expr(f"cast({value} as double)"))
    marks = ", ".join(str(i / pieces) for i in range(1, pieces))
    cuts = rows.agg(F.expr(f"percentile_approx(_v, array({marks}), {100 * pieces})")).first()[0] or []
    hot = sorted({c for c, following in zip(cuts, cuts[1:]) if c == following})
    placed = (rows.withColumn("_cuts", F.array(*[F.lit(c) for c in cuts]))
              .withColumn("_b", F.expr(f"size(filter(_cuts, c -> c < _v)) + pmod(xxhash64({key}), greatest(size(filter(_cuts, c -> c = _v)), 1))")).drop("_cuts"))
    counts = ["count(1) as _c", *[f"count_if(_v < {c!r}D) as _less{i}" for i, c in enumerate(hot)], *[f"count_if(_v = {c!r}D) as _ties{i}" for i, c in enumerate(hot)]]
    whole = [f"sum({c}) over {_over(by)} as {c}" for i in range(len(hot)) for c in (f"_less{i}", f"_ties{i}")]
    before = placed.groupBy(*by, "_b").agg(*map(F.expr, counts)).selectExpr(*by, "_b", f"sum(_c) over {_over(by, '_b')} - _c as _before", f"sum(_c) over {_over(by)} as n", *whole)
    inside = placed.selectExpr("*", f"rank() over {_over([*by, '_b'], '_v')} - 1 as _less", f"count(1) over {_over([*by, '_b', '_v'])} as _ties")
    pick = lambda what, other: f"case {' '.join(f'when _v = {c!r}D then {what}{i}' for i, c in enumerate(hot))} else {other} end" if hot else other
    return inside.join(before, [*by, "_b"]).selectExpr(*df.columns, f"{pick('_less', '_before + _less')} as less", f"{pick('_ties', '_ties')} as ties", "n")


def with_pct_ranks(df: DataFrame, key: str, specs: dict[str, tuple[str, bool]], by: Sequence[str] = ()) -> DataFrame:
    """Add one column per spec (expression, higher_is_better): percentile rank 0..1 with tied
    ranks averaged, over all rows or per `by` group. Null, or a group with at most one value,
    scores 0.5. `key` is the unique key of `df`."""
    by = list(by)
    long = melt(df, [key, *by], {k: e for k, (e, _) in specs.items()}).where("value is not null")
    higher = ", ".join(f"'{k}'" for k, (_, h) in specs.items() if h) or "''"
    rank = "(less + (ties + 1) / 2 - 1) / (n - 1)"
    ranked = (with_positions(long, key, "value", ["component", *by])
              .selectExpr(key, "component", f"case when n <= 1 then 0.5D when component in ({higher}) then {rank} else 1 - {rank} end as r")
              .groupBy(key).agg(*[F.expr(f"max(case when component = '{k}' then r end) as _r_{k}") for k in specs]))
    return df.join(ranked, key, "left").selectExpr(*df.columns, *[f"coalesce(_r_{k}, 0.5D) as {k}" for k in specs])


def with_robust_components(df: DataFrame, key: str, specs: dict[str, dict], z_cap: float = 3.0) -> DataFrame:
    """Add spec["out"] for each metric: 0.5 + 0.5*clip(z/z_cap, -1, 1), z against the peers'
    median/MAD, flipped where lower is better; 0.5 for null or fewer than three values."""
    long = melt(df, [key], {m: m for m in specs}).where("value is not null")
    med = quantiles(long, "value", {"median": 0.5}, ["component"])
    dev = long.join(F.broadcast(med), "component").selectExpr("component", "abs(value - median) as _dev")
    mad = quantiles(dev, "_dev", {"mad": 0.5}, ["component"]).drop("n")
    # One row per configured component, folded into a single map.
    lookup = med.join(F.broadcast(mad), "component").agg(
        F.expr("map_from_entries(collect_list(struct(component, struct(median, mad, n))))")).scalar()
    out = df.withColumn("_base", lookup).selectExpr(
        "*", *[f"_base['{m}'].median as _med_{m}" for m in specs], *[f"_base['{m}'].n as _n_{m}" for m in specs],
        *[f"_base['{m}'].mad as _mad_{m}" for m in specs])
    scores = []
    for m, s in specs.items():
        sign = "" if s["higher_is_better"] else "-"
        z = f"{sign}({m} - _med_{m}) / greatest(1.4826D * _mad_{m}, {float(s['min_scale'])}D) / {float(z_cap)}D"
        scores.append(f"case when {m} is null or coalesce(_n_{m}, 0) < 3 then 0.5D "
                      f"else 0.5D + 0.5D * greatest(-1D, least(1D, {z})) end as {s['out']}")
    return out.selectExpr(*df.columns, *scores)
