"""Operators on hand-made rows, with expected values worked out by hand."""

import datetime as dt
import unicodedata

import numpy as np
import pytest
from demandspark.functions import joins
from demandspark.functions import scalars as S
from demandspark.operators import cluster, enrich, features, hierarchy, panel, reconcile, rules, stockout
from demandspark.plans import registry
from demandspark.sources.scratch import keep
from pyspark.sql import functions as F

LINES = "sku string, description string, supplier string, license string, platform string, month_name string, year int, units double, sales double, cost double"


def lines(spark, *rows):
    return spark.createDataFrame([("1", "d", "s", "L", *r) for r in rows], LINES)


def test_filter_rollup_and_spine(spark):
    df = lines(spark, ("X", "ENERO", 2020, 1.0, 10.0, 2.0), ("Y", "marzo", 2020, None, 5.0, None), (" X", "enero", 2020, 9.0, 9.0, 9.0), ("X", "nope", 2020, 1.0, 1.0, 1.0))
    kept = panel.keep_listed(df, ["X", "Y"], ["bad"])
    assert kept.count() == 3
    rolled = panel.dated(panel.monthly(kept))
    assert {(r.platform, r.date.month, r.units) for r in rolled.collect()} == {("X", 1, 1.0), ("Y", 3, 0.0)}
    full = panel.fill(panel.complete(rolled))
    assert full.count() == 6 and full.agg(F.sum("units")).first()[0] == 1.0
    assert {r.cost for r in full.collect()} == {2.0}
    with pytest.raises(ValueError):
        panel.require(panel.complete(rolled), ["units"])


def test_calendar_without_shuffling_it(spark):
    """Rows with equal keys and dates, a product first seen on one platform and last on another, series without units."""
    form = "sku string, description string, supplier string, license string, platform string, units double, sales double, cost double, date date"
    day = lambda m: dt.date(2020 + (m - 1) // 12, (m - 1) % 12 + 1, 1)
    rows = [("1", "d", "s", "L", "X", 1.0, 1.0, 2.0, day(2)), ("1", "d", "s", "L", "X", 2.0, 1.0, 4.0, day(2)), ("1", "d", "s", "L", "X", 5.0, 1.0, None, day(11)), ("1", "d", "s", "L", "Y", 3.0, 1.0, 1.0, day(14)), ("1", "d", "s", "L", "Z", None, 1.0, 1.0, day(16)), ("1", "e", "s", "L", "X", 1.0, 1.0, 1.0, day(5)), (None, "d", "s", "L", "X", 1.0, 1.0, 1.0, day(1))]
    df = spark.createDataFrame(rows, form)
    got = panel.complete(df)
    months = {}
    for r in got.collect():
        months.setdefault((r.description, r.platform), []).append(((r.date.year - 2020) * 12 + r.date.month, r.units))
    whole = list(range(2, 17))
    assert sorted(months["d", "X"]) == sorted([(2, 1.0), (2, 2.0), (11, 5.0), *((m, None) for m in whole if m not in (2, 11))], key=lambda x: (x[0], x[1] or 0))
    assert sorted(m for m, _ in months["d", "Y"]) == whole and months["e", "X"] == [(5, 1.0)] and set(months) == {("d", "X"), ("d", "Y"), ("e", "X")}
    assert {(r.description, r.platform, r.date) for r in panel.spine(df).collect()} == {(r.description, r.platform, r.date) for r in got.collect()}
    own = panel.complete(df, with_platform=False)
    assert own.where("platform = 'X' and description = 'd'").count() == 11 and own.where("platform = 'Z'").count() == 1
    plan = panel.fill(got)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_significance_modes(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 3.0), ("d", 1.0)], "sku string, units double")
    names = lambda x: {r.sku for r in x.collect()}
    assert names(panel.significant(df, 3)) == {"a"}
    assert names(panel.significant(df, 3, "exact")) == {"a"}
    assert names(panel.significant(df, 2)) == {"a", "b", "c"}
    assert names(panel.significant(df, 2, "exact")) == set()
    assert [r.rank for r in panel.running_share(df).orderBy("rank").collect()] == [1, 2, 3, 4]


def test_rules_and_scalars(spark):
    df = spark.createDataFrame([("Stitch y Star Wars", "DISNEY"), ("star wars", "DISNEY"), ("stitch", "OTRA"), (None, "DISNEY")], "description string, license string")
    assert [r.license for r in rules.relabel_license(df).collect()] == ["STITCH", "STAR WARS", "OTRA", "DISNEY"]
    got = rules.with_product(spark.createDataFrame([("Lámpara",), ("BEANIE",), ("?",)], "description string")).collect()
    assert [r["product"] for r in got] == ["lampara", "guante", "unknown"]
    row = spark.range(1).select(S.short_date(F.lit("3/5/85")).alias("a"), S.short_date(F.lit("3/5/12")).alias("b"), S.strip_unit(F.lit("7.5/10"), "/10").alias("c"), S.strip_unit(F.lit("x"), " min").alias("d")).first()
    assert (row.a.year, row.b.year, row.c, row.d) == (1985, 2012, 7.5, None)


def test_folding_equals_the_standard_library(spark):
    """Each assigned character of the planes in use, in a text of its own, and texts of several; without a Python node."""
    fold = lambda x: None if x is None else unicodedata.normalize("NFKD", x.lower()).encode("ascii", "ignore").decode()
    texts = [f"a{chr(c)}B" for c in (*range(0x20, 0xD800), *range(0xE000, 0x20000)) if unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts += [None, "", "Ñandú ½ ﬁn… №5 ＡＢＣ 𝔸𝕓 ㎏", "e\u0301 \u0130stanbul Łódź ß Ǆ \U0001f100"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.fold_ascii("t").alias("f"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert [(r.t, r.f) for r in df.collect() if r.f != fold(r.t)] == []


def test_runs_and_lags(spark):
    days = [dt.date(2019, 11, 1), dt.date(2019, 12, 1), dt.date(2020, 1, 1), dt.date(2020, 3, 1)]
    df = spark.createDataFrame([("bottom", "s", d, float(i)) for i, d in enumerate(days)], "level string, series_id string, date date, units double")
    run = features.runs(df)
    assert [r.cont_sales_id for r in run.orderBy("date").collect()] == [1, 1, 1, 2]
    counted = features.valid_lags(run, 3).first()
    assert (counted.lag_1, counted.lag_2, counted.lag_3, counted.n_rows) == (2, 1, 0, 4)
    holes = spark.createDataFrame([("bottom", "s", dt.date(2020, m, 1), u) for m, u in ((1, 1.0), (2, None), (3, 2.0), (5, None))], df.schema)
    assert tuple(features.valid_lags(features.runs(holes), 3).first()) == (1, 1, 0, 4)
    none = features.lag_features(run.limit(0), 3)
    assert none.columns == [*run.columns, "sales_roll_3"] and none.count() == 0
    picked = features.lag_features(run, 3, 0.25)
    assert picked.columns == [*run.columns, "lag_1", "lag_2", "sales_roll_3", "lag_1_over_lag_2"] or picked.columns == [*run.columns, "lag_1", "lag_2", "sales_roll_3"]
    assert [r.lag_2 for r in picked.orderBy("date").collect()] == [None, None, 0.0, None]
    got = features.lag_features(run, lags=[1], trends=[]).orderBy("date").collect()
    assert [r.lag_1 for r in got] == [None, 0.0, 1.0, None] and [r.sales_roll_3 for r in got] == [None, 0.0, 0.5, None]
    assert features.choose_trends({"lag_1": 0.1, "lag_2": 0.9, "lag_3": 0.5}) == [("lag_1", "lag_2"), ("lag_2", "lag_3")]
    assert features.choose_trends({}) == []
    assert features.names_in(["lag_2", "lag_1_over_lag_2", "sales_roll_3", "price"]) == ([2], [("lag_1", "lag_2")], [3])


def spread_by_steps(slump, seed):
    out = [s and d for s, d in zip(slump, seed, strict=True)]
    for _ in slump:
        out = [o or (s and ((i > 0 and out[i - 1]) or (i + 1 < len(out) and out[i + 1]))) for i, (o, s) in enumerate(zip(out, slump, strict=True))]
    return [int(o and (i == 0 or (i > 0 and out[i - 1]) or (i + 1 < len(out) and out[i + 1]))) for i, o in enumerate(out)]


def test_stockout_spread(spark):
    r, rows, want = np.random.default_rng(1), [], {}
    for k in range(60):
        slump = r.integers(0, 2, r.integers(1, 12)).tolist()
        seed = [int(s and r.random() < 0.4) for s in slump]
        want[str(k)] = spread_by_steps(slump, seed)
        rows += [(str(k), dt.date(2020 + i // 12, i % 12 + 1, 1), s, d, i == 0) for i, (s, d) in enumerate(zip(slump, seed, strict=True))]
    df = spark.createDataFrame(rows, "sku_platform string, date date, slump int, seed int, is_first boolean")
    got = {}
    for x in stockout.spread(df).orderBy("sku_platform", "date").collect():
        got.setdefault(x.sku_platform, []).append(x.stockout)
    assert got == want


def test_poisson_score_equations(spark):
    r = np.random.default_rng(2)
    rows = [(str(g), float(r.poisson(3 + g % 4)), float(r.normal(10, 2)), float(r.normal(1e5, 1e4))) for g in range(12) for _ in range(15)] + [("z", 0.0, 1.0, 1e5)] * 3
    df = spark.createDataFrame(rows, "sku_platform string, units double, price double, platform_monthly_sales double")
    p = stockout.poisson_effects(df)[0].toPandas()
    by = p.groupby("sku_platform")[["units", "pred"]].sum()
    assert np.allclose(by.units, by.pred, atol=1e-6)
    gap = p.units - p.pred
    assert abs((gap * (p.price - p.price.mean())).sum()) < 1e-3
    assert abs((gap * (p.platform_monthly_sales - p.platform_monthly_sales.mean())).sum()) < 10


def test_reconciliation_equals_least_squares(spark):
    r, day = np.random.default_rng(3), dt.date(2021, 1, 1)
    tree = [("a", 0, "L"), ("b", 0, "L"), ("c", 1, "L"), ("d", 1, "L"), ("e", 1, "L")]
    base = r.normal(10, 4, 5)
    up = {"cluster": {"0": 30.0, "1": 20.0}, "license": {"L": 60.0}}
    rows = [("bottom", s, day, float(x), 1, c, l) for (s, c, l), x in zip(tree, base, strict=True)]
    rows += [(lv, k, day, v, 2, None, None) for lv, xs in up.items() for k, v in xs.items()]
    f = spark.createDataFrame(rows, "level string, series_id string, date date, units double, count long, cluster int, license string")
    dense = reconcile.densify(f)
    t = f.where("level = 'bottom'").select("series_id", "cluster", "license")
    got = {x.series_id: x.reconciled for x in reconcile.reconciled_bottom(dense, t).collect()}
    s = np.vstack([np.ones(5), [1, 1, 0, 0, 0], [0, 0, 1, 1, 1], np.eye(5)])
    w = np.diag(1 / s.sum(1))
    y = np.r_[60.0, 30.0, 20.0, base]
    want = np.linalg.solve(s.T @ w @ s, s.T @ w @ y)
    assert np.allclose([got[k] for k in "abcde"], want)


def conditions(rows, f_c, f_l):
    """Largest breach of the optimality conditions of one license and month; rows are (cluster, base, reconciled)."""
    code, base, b = (np.array(x, dtype=float) for x in zip(*rows, strict=True))
    code = code.astype(int)
    n = np.bincount(code)
    slope = (b - base) - ((f_c - np.bincount(code, b)) / n)[code] - (f_l - b.sum()) / len(b)
    return max(-b.min(), np.abs(slope[b > 0]).max(initial=0), -slope[b == 0].min(initial=0))


def test_nonnegative_solution_meets_its_conditions(spark):
    r, rows = np.random.default_rng(5), []
    for k in range(12):
        day, lic = dt.date(2021, 1 + k % 3, 1), f"L{k // 3}"
        code = r.integers(0, 4, 30) if k else np.array([0, 0, 1, 1])
        base = r.normal(2, 6, 30) if k else np.array([1.0, -6.0, 3.0, 2.0])
        rows += [("bottom", f"{lic}-{i}-{c}", day, float(x), 1, int(c), lic) for i, (c, x) in enumerate(zip(code, base, strict=True))]
        rows += [("cluster", f"{lic}{c}", day, float(r.normal(10, 9)), 2, None, None) for c in np.unique(code)] + [("license", lic, day, float(r.normal(30, 30)), 2, None, None)]
    # every series stands in one cluster of its license over all months
    f = spark.createDataFrame([(a, b, d, x, n, f"{l}{c}" if l else None, l) for a, b, d, x, n, c, l in rows], "level string, series_id string, date date, units double, count long, cluster string, license string")
    tree = f.where("level = 'bottom'").select("series_id", "cluster", "license").distinct()
    dense = reconcile.densify(f)
    top = {(x.level, x.series_id, x.date): x.units for x in dense.collect()}
    groups = {}
    for x in reconcile.nonnegative_bottom(dense, tree).collect():
        groups.setdefault((x.license, x.date), []).append((x.cluster, x.units, x.reconciled))
    assert any(v == 0 for g in groups.values() for *_, v in g)
    for (lic, day), g in groups.items():
        names = sorted({c for c, *_ in g})
        f_c = np.array([top["cluster", c, day] for c in names])
        assert conditions([(names.index(c), b, v) for c, b, v in g], f_c, top["license", lic, day]) < 1e-7


def test_hierarchy_and_clusters(spark):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("a_X", "L", 0, day, 1.0, 2.0, 3.0, "s"), ("b_X", "L", 0, day, 2.0, None, 6.0, "t"), ("c_X", None, None, day, 5.0, 1.0, 1.0, "t")], "sku_platform string, license string, cluster int, date date, units double, sales double, cost double, supplier string")
    out = hierarchy.stack(df, ("license",), categories=("supplier",))
    up = out.where("level = 'license'").collect()
    assert len(up) == 1 and (up[0].units, up[0].sales, up[0]["count"], up[0].cost, up[0].supplier) == (3.0, 2.0, 2, 5.0, None)
    deep = hierarchy.stack(df.withColumn("product", F.lit("p")), ("cluster", "license"), categories=("supplier", "license", "product"))
    rows = {(r.level, r.series_id): r for r in deep.collect()}
    assert deep.columns[:8] == df.columns and set(rows) == {("bottom", "a_X"), ("bottom", "b_X"), ("bottom", "c_X"), ("cluster", "0"), ("license", "L")}
    assert (rows["cluster", "0"].license, rows["cluster", "0"].cluster, rows["cluster", "0"].supplier, rows["license", "L"].cluster, rows["license", "L"]["product"]) == ("L", 0, None, None, "p")
    kept = keep(df, "levels")
    plan = hierarchy.stack(kept, ("cluster", "license"), categories=("supplier",), kept={"cluster": [], "license": []})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 2 and "Join" not in plan
    split = cluster.split_clusters(spark.createDataFrame([(1, "L", "p"), (0, "L", "p"), (0, "K", "p"), (0, None, "p")], "raw_cluster int, license string, product string"))
    assert sorted((r.raw_cluster, r.license or "", r.cluster) for r in split.collect()) == [(0, "", None), (0, "K", 0), (0, "L", 1), (1, "L", 2)]


def test_interest(spark):
    df = spark.createDataFrame([("L", *map(float, range(1, 13))), ("Z", *[0.0] * 12)], "license string, " + ", ".join(f"m{i} double" for i in range(12)))
    got = {r.license: r for r in enrich.interest(df).collect()}
    assert got["L"].moviemeter_average == 6.5 and got["L"].moviemeter_trend_3 == (11 + 12 + 6.5) / 6 and got["Z"].moviemeter_trend_3 is None
    with pytest.raises(ValueError):
        enrich.interest(df.select("license", "m1", "m2"))


def dense_solution(paths, base, upper, variance):
    """Least squares over all nodes by one dense system; a missing forecast has no row."""
    rows, y, w = [np.eye(len(paths))[i] for i in range(len(paths))], list(base), [1 / variance["bottom", s] for s, *_ in paths]
    for (level, node), f in upper.items():
        at = [k for k, n in enumerate(level.split("|")) if n][0]
        rows.append(np.array([float(p[at] == node) for p in paths]))
        y.append(f)
        w.append(1 / variance[level, node])
    s, w = np.array(rows), np.diag(w)
    return np.linalg.solve(s.T @ w @ s, s.T @ w @ np.array(y)), s, w, np.array(y)


def deep_forecast(spark, r, depth, missing=0):
    """A random tree of ``depth`` levels above the bottom, with forecasts of two months; (rows, paths, base, upper) by month."""
    parents = [f"p{k}" for k in range(1, depth + 1)]
    sizes = [24, 9, 4, 2][:depth]
    above = [r.integers(0, sizes[k + 1], sizes[k]) for k in range(depth - 1)]
    paths = []
    for i in range(60):
        node = [int(r.integers(0, sizes[0]))]
        for a in above:
            node.append(int(a[node[-1]]))
        paths.append((f"s{i}", *(f"{p}-{n}" for p, n in zip(parents, node, strict=True))))
    days = [dt.date(2021, 1, 1), dt.date(2021, 2, 1)]
    rows, base, upper = [], {}, {}
    for d in days:
        base[d] = r.normal(3, 6, 60)
        rows += [("bottom", p[0], d, float(x), 1, *p[1:]) for p, x in zip(paths, base[d], strict=True)]
        upper[d] = {}
        for k, p in enumerate(parents, 1):
            for node in sorted({x[k] for x in paths})[missing:]:
                f = float(r.normal(20 * k, 25))
                upper[d]["|" * k + p, node] = f
                rows.append((p, node, d, f, 9, *[None] * depth))
    form = "level string, series_id string, date date, units double, count long, " + ", ".join(f"{p} string" for p in parents)
    return spark.createDataFrame(rows, form), parents, paths, base, upper


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_any_depth_equals_a_dense_solution(spark, depth):
    r = np.random.default_rng(depth)
    f, parents, paths, base, upper = deep_forecast(spark, r, depth)
    nodes = [("bottom", p[0]) for p in paths] + sorted({(lv, n) for u in upper.values() for lv, n in u})
    own = {x: float(r.uniform(0.2, 5)) for x in nodes}
    size = {x: float(sum(x[1] in p for p in paths)) for x in nodes}
    tree = reconcile.path_of(f.where("level = 'bottom'"), parents)
    table = spark.createDataFrame([(lv.strip("|"), n, v) for (lv, n), v in own.items()], "level string, series_id string, variance double")
    for variance, given in ((size, None), (own, table)):
        got = {(x.series_id, x.date): x.reconciled for x in reconcile.least_squares(f, tree, parents, given).collect()}
        for d in base:
            want = dense_solution(paths, base[d], upper[d], variance)[0]
            assert np.allclose([got[p[0], d] for p in paths], want)


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_no_negatives_at_any_depth(spark, depth):
    """The optimality conditions of the dense problem: slope 0 above 0, and none that would gain by leaving 0."""
    r = np.random.default_rng(10 + depth)
    f, parents, paths, base, upper = deep_forecast(spark, r, depth)
    nodes = [("bottom", p[0]) for p in paths] + sorted({(lv, n) for u in upper.values() for lv, n in u})
    own = {x: float(r.uniform(0.2, 5)) for x in nodes}
    table = spark.createDataFrame([(lv.strip("|"), n, v) for (lv, n), v in own.items()], "level string, series_id string, variance double")
    tree = reconcile.path_of(f.where("level = 'bottom'"), parents)
    got = {(x.series_id, x.date): x.reconciled for x in reconcile.least_squares(f, tree, parents, table, nonnegative=True).collect()}
    assert any(v == 0 for v in got.values())
    for d in base:
        _, s, w, y = dense_solution(paths, base[d], upper[d], own)
        b = np.array([got[p[0], d] for p in paths])
        slope = s.T @ w @ (s @ b - y)
        assert b.min() >= 0 and np.abs(slope[b > 0]).max(initial=0) < 1e-7 and slope[b == 0].min(initial=0) > -1e-7


def test_nodes_of_variance_zero_without_forecasts_or_parents(spark):
    """Series a, b under P and c under Q; a is certain, P is certain; Q has no forecast of its own."""
    day = dt.date(2021, 1, 1)
    rows = [("bottom", "a", day, 4.0, 1, "P"), ("bottom", "b", day, 3.0, 1, "P"), ("bottom", "c", day, -2.0, 1, "Q"), ("p", "P", day, 10.0, 2, None)]
    f = spark.createDataFrame(rows, "level string, series_id string, date date, units double, count long, p string")
    tree = reconcile.path_of(f.where("level = 'bottom'"), ["p"])
    v = spark.createDataFrame([("bottom", "a", 0.0), ("bottom", "b", 2.0), ("p", "P", 0.0)], "level string, series_id string, variance double")
    solve = lambda *a, **k: {x.series_id: x.reconciled for x in reconcile.least_squares(f, tree, ["p"], *a, **k).collect()}
    assert solve(v) == {"a": 4.0, "b": 6.0, "c": -2.0}
    assert solve(v, nonnegative=True) == {"a": 4.0, "b": 6.0, "c": 0.0}
    both = spark.createDataFrame([("bottom", "a", 0.0), ("bottom", "b", 0.0), ("p", "P", 0.0)], "level string, series_id string, variance double")
    assert solve(both) == {"a": 4.0, "b": 3.0, "c": -2.0}
    low = f.withColumn("units", F.when(F.col("level") == "p", -1.0).otherwise(F.col("units")))
    got = {x.series_id: x.reconciled for x in reconcile.least_squares(low, tree, ["p"], v, nonnegative=True).collect()}
    assert got == {"a": 4.0, "b": 0.0, "c": 0.0}
    for bad in ([("bottom", "a", day, 1.0, 1, "P"), ("bottom", "a", day, 1.0, 1, "Q")], [("bottom", "a", day, 1.0, 1, None)]):
        with pytest.raises(ValueError, match="not a tree"):
            reconcile.path_of(spark.createDataFrame(bad, f.schema), ["p"])
    alone = reconcile.least_squares(f, reconcile.path_of(f.where("level = 'bottom'"), []), [], nonnegative=True)
    assert {x.series_id: x.reconciled for x in alone.collect()} == {"a": 4.0, "b": 3.0, "c": 0.0}
    with pytest.raises(ValueError, match="unknown method"):
        reconcile.reconcile(f, ["p"], "other")
    with pytest.raises(ValueError, match="wls_var"):
        reconcile.reconcile(f, ["p"], "wls_var")


def test_look_ups_and_running_sums_of_hot_keys(spark):
    r = np.random.default_rng(4)
    keys = np.where(r.random(3000) < 0.5, 7, r.integers(0, 900, 3000))
    rows = spark.createDataFrame([(int(k) if i % 97 else None, i) for i, k in enumerate(keys)], "k long, i long")
    table = keep(spark.createDataFrame([(k, k * 10) for k in range(0, 900, 2)], "k long, x long"), "table")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(map(tuple, rows.join(table, "k", how).collect()), key=str)
        for most in (10_000, 5):
            assert sorted(map(tuple, joins.look_up(rows, table, ["k"], how, most).collect()), key=str) == want
    plan = joins.look_up(rows, table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    lines = spark.createDataFrame([(int(k % 3), float(x), i) for i, (k, x) in enumerate(zip(keys, r.random(3000), strict=True))], "g int, x double, i int")
    total, want = {}, {}
    for g, x, i in sorted(map(tuple, lines.collect()), key=lambda z: (z[0], z[1], z[2])):
        total[g] = want[i] = total.get(g, 0.0) + x
    got = {z.i: z.s for z in joins.running_sums(lines, ["g"], ["x", "i"], {"x": "s"}).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_enrichment_wants_one_row_for_a_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "license string, i int")
    dim = spark.createDataFrame([("a", 1.0), (None, 2.0)], "license string, x double")
    assert sorted((r.i, r.x) for r in enrich.enrich(rows, [dim]).collect()) == [(1, 1.0), (2, 1.0), (3, None), (4, None)]
    twice = dim.union(dim)
    with pytest.raises(ValueError, match="several rows for license"):
        enrich.enrich(rows, [twice])
    assert enrich.enrich(rows, [twice], unique=False).count() == 6


def test_stockout_chain_moves_the_panel_once(spark):
    """Totals of platforms are broadcast; price, effect and labels share one exchange by series."""
    rows = [("a_X", "X", dt.date(2020, m, 1), float(m % 3), 10.0 * m) for m in range(1, 13)] + [("b_Y", "Y", dt.date(2020, m, 1), 2.0, None) for m in range(1, 7)]
    df = keep(spark.createDataFrame(rows, "sku_platform string, platform string, date date, units double, sales double"), "panel")
    exchanges = lambda x: x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    totals = stockout.with_platform_months(df)
    assert exchanges(totals) == 0 and {(r.platform, r.date.month, r.platform_monthly_sales) for r in totals.collect()} == {(p, d.month, u) for _, p, d, u, _ in rows}
    priced = stockout.with_price(df)
    assert exchanges(stockout.label(priced.withColumn("pred", F.lit(1.0)))) == 1
    got = {(r.sku_platform, r.date.month): r.price for r in priced.collect()}
    sold = [(u, s) for k, _, _, u, s in rows if k == "a_X" and u]
    assert got["a_X", 3] == pytest.approx(sum(s for _, s in sold) / sum(u for u, _ in sold)) and got["a_X", 4] == 40.0 and got["b_Y", 1] is None


def test_fits_that_do_not_settle_say_so(spark):
    r = np.random.default_rng(2)
    rows = [(str(g), float(r.poisson(3 + g)), float(r.normal(10, 2)), float(r.normal(5, 1))) for g in range(4) for _ in range(9)]
    df = spark.createDataFrame(rows, "sku_platform string, units double, price double, platform_monthly_sales double")
    with pytest.warns(RuntimeWarning, match="did not settle"):
        stockout.poisson_effects(df, steps=1)


def test_price_cells_cost_what_they_hold(spark, tmp_path):
    """Prices far apart make millions of cells, of which a product has five; the dense vector has the same entries."""
    day = dt.datetime(2020, 1, 5)
    sold = [(k, float(u), float(x), 0.0, "A", day if m else None) for k, u, x, m in ((1, 2, 20, 1), (2, 1, 100_000_020, 1), (2, 1, 100_000_020, 1), (3, 0, 70, 1), (4, 1, 10, 0))]
    spark.createDataFrame(sold, "l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp").where("l_quantity > 0").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "ring", "Brand#1", "SMALL") for k in range(1, 5)], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.price_vectors(spark, str(tmp_path)).collect()
    assert sorted((r.sku, r.cell) for r in got) == sorted([*(("1", k) for k in range(5)), *(("2", k) for k in range(2_000_000, 2_000_005))])
    assert all(r.weight == pytest.approx([0.25, 0.5, 1, 0.5, 0.25][r.cell % 2_000_000] / 1.625**0.5, abs=1e-6) for r in got)
    # at an end without spare cells, with fewer weights than neighbours, and without price
    near = lambda price, cells, **more: S.price_cells(F.lit(price).cast("double"), 0, cells, 10, **more)
    row = spark.range(1).select(S.price_vector(near(5, 4), 4).alias("low"), S.price_vector(near(35, 4, weights=(1.0, 1.0)), 4).alias("high"), S.price_vector(near(None, 3), 3).alias("none")).first()
    assert row.low == pytest.approx([x / 1.3125**0.5 for x in (1, 0.5, 0.25, 0)]) and row.high == pytest.approx([0, 0, 0.5**0.5, 0.5**0.5]) and row.none == [0, 0, 0]


def test_products_need_no_calendar(spark):
    """The months that the calendar adds change no total of a product."""
    rolled = panel.dated(panel.monthly(lines(spark, ("X", "enero", 2020, 1.0, 10.0, 2.0), ("X", "mayo", 2020, None, 5.0, None), ("Y", "marzo", 2020, 2.0, None, 1.0))))
    want = [("1", "d", "s", "L", 15.0, 3.0, 5.0)]
    assert [tuple(r) for r in cluster.sku_dimension(rolled).collect()] == [tuple(r) for r in cluster.sku_dimension(panel.fill(panel.complete(rolled))).collect()] == want


def shop(spark, at, n=40):
    """Tables of sale lines by part: ``n`` parts of two licenses and two labels, sold in January and in May."""
    day = lambda m: dt.datetime(2020, m, 5)
    sold = [(k, 1.0 + k % 3, (1.0 + k % 3) * 100 * (k % 7), 0.0, "A", day(m)) for k in range(n) for m in (1, 5)]
    spark.createDataFrame(sold, "l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(k, ("hot ring", "old rod")[k % 2], "Brand#1", ("SMALL", "LARGE")[k // 2 % 2]) for k in range(n)], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{at}/part.parquet")
    return str(at)


def test_clusters_are_made_of_products_alone(spark, tmp_path):
    """Neither the sale lines nor their panel are read again for the result."""
    with pytest.warns(RuntimeWarning, match="40 products make no 200 clusters"):
        out = registry.product_clusters(spark, shop(spark, tmp_path))
    assert not [f for f in out.inputFiles() if "lineitem" in f]
    got = {r.sku: r for r in out.collect()}
    assert set(got) == {str(k) for k in range(40)} and {got["0"]["product"], got["1"]["product"]} == {"ring", "bar"}
    # equal vectors are in one cluster, others of these few in different ones
    kinds = {}
    for k in range(40):
        kinds.setdefault((k % 2, k // 2 % 2, k % 7), set()).add(got[str(k)].cluster)
    assert all(len(x) == 1 for x in kinds.values()) and {min(x) for x in kinds.values()} == set(range(len(kinds)))
    rows = spark.createDataFrame([("1", "hot ring", "s", "L", 1.0, 5.0, 1), ("1", "hot ring", "s", "L", 0.0, None, 2), ("2", "rod", "s", "M", 1.0, 500.0, 1), (None, "rod", "s", "M", 1.0, 1.0, 1)], "sku string, description string, supplier string, license string, units double, sales double, i int")
    with pytest.warns(RuntimeWarning, match="2 products"):
        back = cluster.categorize(rows, labels=("ring", "rod"))
    assert back.columns == [*rows.columns, "product", "cluster"] and sorted((r.i, r["product"], r.cluster is None) for r in back.collect() if r.sku) == [(1, "ring", False), (1, "rod", False), (2, "ring", False)]
    assert [tuple(r)[-2:] for r in back.where("sku is null").collect()] == [(None, None)]


def test_cluster_rules_read_the_lines_once(spark, tmp_path):
    with pytest.warns(RuntimeWarning, match="40 products"):
        out = registry.product_cluster_rules(spark, shop(spark, tmp_path))
    assert not [f for f in out.inputFiles() if "lineitem" in f]
    assert [tuple(r) for r in out.collect()] == [(40, True, True, True)]
