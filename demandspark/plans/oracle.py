"""DuckDB twins of the queries: shared common table expressions and one statement per query."""

from __future__ import annotations

from demandspark.schema import MONTHS

LEAST = 700.0
CUTOFF = "2001-01-01"
LABELS = ("ring", "rod", "plate", "gear", "bolt", "anvil", "widget")
SYNONYMS = {"rod": "bar", "bolt": "screw"}
LICENSES = (("ECONOMY", "ring", "RINGS"), ("ECONOMY", "small", "SMALLS"), ("PROMO", "gear", "GEARS"))

_NAMES = "case month(l_shipdate) " + " ".join(f"when {i} then '{m}'" for i, m in enumerate(MONTHS, 1)) + " end"
_MEASURES = f"{_NAMES} as month_name, cast(year(l_shipdate) as integer) as year, make_date(year(l_shipdate), month(l_shipdate), 1) as date, l_quantity as units, l_extendedprice as sales, round(l_extendedprice * (1 - l_discount) / l_quantity + 1e-9, 4) as cost"
_KEYS = "sku, description, supplier, license, platform"


def _panel(x: str, where: str) -> str:
    return f"""
{x}_rolled as (select {_KEYS}, date, coalesce(sum(units), 0) as units, coalesce(sum(sales), 0) as sales, avg(cost) as cost from {x}_lines where {where} group by {_KEYS}, date),
{x}_ranges as (select sku, description, supplier, license, min(date) as first, max(date) as last from {x}_rolled group by all),
{x}_spine as (select sku, description, supplier, license, platform, cast(unnest(generate_series(first, last, interval 1 month)) as date) as date from (select distinct {_KEYS} from {x}_rolled) join {x}_ranges using (sku, description, supplier, license)),
{x}_full as (select * from {x}_spine left join {x}_rolled using ({_KEYS}, date)),
{x}_mean as (select sku, sum(cost * coalesce(units, 0)) / nullif(sum(case when cost is not null then coalesce(units, 0) end), 0) as mean_cost from {x}_full group by sku),
{x}_filled as (select {_KEYS}, date, coalesce(units, 0) as units, sales, coalesce(cost, mean_cost) as cost, sku || '_' || platform as sku_platform from {x}_full join {x}_mean using (sku))"""


_SLOPE = "(-(2.0 - 1.0) / ln(11.0))"
_CTES = f"""with
a_lines as (select cast(p_partkey as varchar) as sku, p_name as description, p_brand as supplier, p_type as license, l_returnflag as platform, {_MEASURES} from lineitem join part on l_partkey = p_partkey),
b_lines as (select cast(s_suppkey as varchar) as sku, s_name as description, n_name as supplier, r_name as license, l_linestatus as platform, {_MEASURES}
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
{_panel("a", "platform in ('A', 'N') and supplier <> 'Brand#2'").strip()},
{_panel("b", "platform in ('F', 'O')").strip()},
dim as (select sku, description, supplier, license, coalesce(sum(sales), 0) as sales, sum(units) as units, sum(sales) / nullif(sum(units), 0) as price from a_filled group by all),
sku_units as (select sku, sum(units) as units from a_rolled group by sku),
clu as (select license, supplier, dense_rank() over (order by license, supplier) - 1 as cluster from (select distinct license, supplier from b_filled)),
c as (select f.*, substr(description, 1, 8) as product, cast(cluster as integer) as cluster from b_filled f join clu using (license, supplier)),
pred as (select *, avg(units) over (partition by sku_platform) as pred from b_filled),
res as (select *, coalesce((units - pred) / nullif(sqrt(pred), 0), 0) as residuals from pred),
flags as (select *, cast(residuals > 1.25 as integer) as surge, cast(residuals < {_SLOPE} * ln(1 + units) - 1.0 as integer) as slump, row_number() over (partition by sku_platform order by date) = 1 as is_first from res),
seeds as (select *, cast(slump = 1 and (coalesce(lag(surge) over w, 0) = 1 or coalesce(lead(surge) over w, 0) = 1 or is_first) as integer) as seed from flags window w as (partition by sku_platform order by date)),
turns as (select *, case when slump <> lag(slump) over w then 1 else 0 end as turn from seeds window w as (partition by sku_platform order by date)),
islands as (select *, sum(turn) over (partition by sku_platform order by date rows unbounded preceding) as island from turns),
labelled as (select *, cast(slump = 1 and max(seed) over i = 1 and (count(*) over i >= 2 or is_first) as integer) as stockout from islands window i as (partition by sku_platform, island)),
stacked as (
  select 'bottom' as level, sku_platform as series_id, date, units, sales, cost, 1::bigint as count, supplier, license, product, sku, cluster from c
  union all select 'cluster', cast(cluster as varchar), date, sum(units), coalesce(sum(sales), 0), (select sum(cost * units) / nullif(sum(case when cost is not null then units end), 0) from c k where k.cluster = c.cluster), count(*), max(supplier), max(license), max(product), null, cluster from c group by cluster, date
  union all select 'license', license, date, sum(units), coalesce(sum(sales), 0), (select sum(cost * units) / nullif(sum(case when cost is not null then units end), 0) from c k where k.license = c.license), count(*), null, license, max(product), null, null from c group by license, date),
stacked_steps as (select *, (year(date) * 12 + month(date)) - lag(year(date) * 12 + month(date)) over (partition by level, series_id order by date) as gap from stacked),
stacked_runs as (select *, cast(sum(case when gap = 1 then 0 else 1 end) over (partition by level, series_id order by date rows unbounded preceding) as bigint) as cont_sales_id from stacked_steps),
priced as (select sku_platform, units, coalesce(sales / nullif(units, 0), sum(sales / nullif(units, 0) * units) over w / nullif(sum(case when sales / nullif(units, 0) is not null then units end) over w, 0)) as price from b_filled window w as (partition by sku_platform)),
steps as (select *, sku || '_' || platform as series_id, (year(date) * 12 + month(date)) - lag(year(date) * 12 + month(date)) over (partition by sku, platform order by date) as gap from a_rolled),
runs as (select *, cast(sum(case when gap = 1 then 0 else 1 end) over (partition by series_id order by date rows unbounded preceding) as bigint) as cont_sales_id from steps),
lags as (select *, lag(units, 1) over w as lag_1, lag(units, 2) over w as lag_2, lag(units, 3) over w as lag_3, avg(units) over (partition by series_id, cont_sales_id order by date rows between 3 preceding and 1 preceding) as sales_roll_3, row_number() over w - 1 as months_on_shelf
  from runs window w as (partition by series_id, cont_sales_id order by date)),
months as (select year(d) * 12 + month(d) as m from (select unnest(generate_series(date_trunc('month', min(l_shipdate)), max(l_shipdate), interval 1 month)) as d from lineitem)),
seen as (select p_type as license, year(l_shipdate) * 12 + month(l_shipdate) as m, count(*) as n from lineitem join part on l_partkey = p_partkey group by all),
wide as (select license, list(coalesce(n, 0)::double order by m) as v from (select distinct license from seen) cross join months left join seen using (license, m) group by license),
inter as (select license, v, list_sum(v) / len(v) as av, list_sum(v[1:3]) as f3, list_sum(v[1:6]) as f6 from wide),
inter3 as (select *, (list_sum(v[-2:]) + av) / nullif(f3, 0) as t3 from inter),
titles as (select p_type as license, count(*) as n, max(p_size) as size, round(avg(p_retailprice), 2) as budget from part group by p_type),
prep as (select s.*, date < date '{CUTOFF}' as early from stacked s),
fbottom as (select 'bottom' as level, sku_platform as series_id, date, units / 2 as units, 1::bigint as count, cluster, license from c where date >= date '{CUTOFF}' and units > 0),
fall as (select * from fbottom
  union all select 'cluster', cast(cluster as varchar), date, sum(units) * 1.1, count(*), cluster, null from fbottom group by cluster, date having count(*) > 1
  union all select 'license', license, date, sum(units) * 1.1, count(*), null, license from fbottom group by license, date having count(*) > 1),
kids as (select cluster, date, count(distinct series_id) as n_children from fbottom group by all),
kids_l as (select license, date, count(distinct series_id) as n_children from fbottom group by all),
restored as (select level, series_id, date, units from fall
  union all select 'cluster', cast(cluster as varchar), date, units from fbottom join kids using (cluster, date) where n_children = 1
  union all select 'license', license, date, units from fbottom join kids_l using (license, date) where n_children = 1),
dense as (select level, series_id, date, coalesce(max(units), 0) as units from (select distinct level, series_id from restored) cross join (select distinct date from restored) left join restored using (level, series_id, date) group by all),
tree as (select distinct series_id, cluster, license from fbottom),
fedges as (select 'bottom' as level, series_id as parent_id, series_id as child_id from tree union select 'cluster', cast(cluster as varchar), series_id from tree union select 'license', license, series_id from tree),
g as (select license, cluster, date, b_c, sum(b_c) over (partition by license, date) as b_l, n_c, sum(n_c) over (partition by license, date) as n_l
  from (select license, cluster, date, sum(units) as b_c, count(*) as n_c from dense join tree using (series_id) where level = 'bottom' group by all)),
gf as (select g.*, coalesce(k.units, b_c) as f_c, coalesce(l.units, b_l) as f_l from g left join dense k on k.level = 'cluster' and k.series_id = cast(g.cluster as varchar) and k.date = g.date left join dense l on l.level = 'license' and l.series_id = g.license and l.date = g.date),
sh as (select license, cluster, date, ((f_c - b_c) / n_c + ((f_l - b_l) - (sum(f_c - b_c) over (partition by license, date) + (f_l - b_l)) / 3) / n_l) / 2 as delta from gf),
rec as (select series_id, date, units, units + delta as reconciled from dense join tree using (series_id) join sh using (license, cluster, date) where level = 'bottom')
"""


def _lags(rows: str, most: int, share: float, keys: str) -> str:
    """Lags that enough rows have, the trends chosen of them and the rolling mean, as rows of name and value. A row's lags are a list, so nothing is joined."""
    lags = ", ".join(f"lag(units, {k}) over w" for k in range(1, most + 1))
    return f""", lagged as (select {keys}, units, [{lags}] as l, avg(units) over (partition by level, series_id, cont_sales_id order by date rows between 3 preceding and 1 preceding) as roll from ({rows}) window w as (partition by level, series_id, cont_sales_id order by date)),
kept as (select k, corr(l[k], units) as r from lagged, (select unnest(range(1, {most + 1})) as k) group by k having count(l[k]) >= {share} * count(*)),
best as (select k from kept order by coalesce(r, -2) desc, k limit 1),
pairs as (select (select k from kept order by k limit 1) as a, (select k from kept order by k limit 1 offset 1) as b where (select count(*) from kept) > 2
  union select (select k from best), (select k from kept where k > (select k from best) order by coalesce(r, -2) desc, k limit 1)),
named as (select {keys}, 'lag_' || k as name, l[k] as value from lagged, kept
  union all select {keys}, 'sales_roll_3', roll from lagged
  union all select {keys}, 'lag_' || a || '_over_lag_' || b, l[a] / nullif(l[b], 0) from lagged, pairs)
select {keys}, name, round(value + 1e-9, 4) + 0.0 as value from named where value is not null"""


_DEEP = f""", deep as (select sku || '_' || platform as series_id, date, units / 2 as units, sku, license || '/' || supplier as grp, license from a_rolled where date >= date '{CUTOFF}' and units > 0),
""" + ",\n".join(f"deep_{x} as (select '{x}' as level, {x} as series_id, date, case when count(*) = 1 then max(units) else sum(units) * {t} end as units from deep group by {x}, date)" for x, t in (("sku", 1.1), ("grp", 1.2), ("license", 0.9))) + """,
deep_some as (select 'bottom' as level, series_id, date, units from deep union all from deep_sku union all from deep_grp union all from deep_license),
deep_dense as (select level, series_id, date, coalesce(units, 0) as units from (select distinct level, series_id from deep_some) cross join (select distinct date from deep) left join deep_some using (level, series_id, date)),
deep_tree as (select distinct series_id, sku, grp, license from deep),
deep_nodes as (select 'bottom' as level, series_id, 1.0::double as size from deep_tree union all select 'sku', sku, count(*) from deep_tree group by sku union all select 'grp', grp, count(*) from deep_tree group by grp union all select 'license', license, count(*) from deep_tree group by license)"""


def _two_passes(spread: str) -> str:
    """Least squares over the three levels, by one aggregation a level upwards and one join a level downwards; ``spread`` gives (level, series_id, v)."""
    out, keys, last = f"""{_DEEP}, spread as ({spread}),
up0 as (select t.*, date, units, units as m, v as r from deep_dense d join deep_tree t using (series_id) join spread s on s.level = 'bottom' and s.series_id = d.series_id where d.level = 'bottom')""", ["sku", "grp", "license"], "up0"
    for i, x in enumerate(keys, 1):
        own = ", ".join(keys[i - 1 :])
        out += f""",
sum{i} as (select {own}, date, sum(m) as bm, sum(r) as br from {last} group by {own}, date),
gain{i} as (select a.*, case when d.units is null then 0 else coalesce(br / nullif(br + v, 0), 0) end as k, coalesce(d.units, 0) as f from sum{i} a left join deep_dense d on d.level = '{x}' and d.series_id = a.{x} and d.date = a.date left join spread s on s.level = '{x}' and s.series_id = a.{x}),
up{i} as (select {own}, date, bm, br, bm + k * (f - bm) as m, br * (1 - k) as r from gain{i})"""
        last = f"up{i}"
    out += ", down3 as (select *, m as s from up3)"
    for i in (2, 1, 0):
        on = ", ".join([*keys[i:], "date"])
        out += f", down{i} as (select u.*, u.m + u.r * coalesce((p.s - p.bm) / nullif(p.br, 0), 0) as s from up{i} u join down{i + 1} p using ({on}))"
    return out + "\nselect series_id, date, round(units + 1e-9, 4) as units, round(s + 1e-9, 4) + 0.0 as reconciled from down0"


_SPREAD = f"""with months as (select sku || '_' || platform as series_id, date, units, sku, license || '/' || supplier as grp, license from a_rolled where date < date '{CUTOFF}'),
  known as (select level, series_id, var_pop(units) as v from (select level, series_id, date, sum(units) as units from (
    select 'bottom' as level, series_id, date, units from months union all select 'sku', sku, date, units from months union all select 'grp', grp, date, units from months union all select 'license', license, date, units from months) group by all) group by all),
  usual as (select level, avg(v) as u from known group by level)
  select n.level, n.series_id, coalesce(v, u, 1.0) as v from deep_nodes n left join known using (level, series_id) left join usual on usual.level = n.level"""


def _cased(column: str, pairs) -> str:
    return " ".join(f"when {column} = '{a}' then '{b}'" for a, b in pairs)


def statements() -> dict[str, str]:
    """Query name -> DuckDB SQL."""
    first_label = "case " + " ".join(f"when contains(lower(p_name), '{x}') then '{x}'" for x in LABELS) + " else 'unknown' end"
    licenses = "case " + " ".join(f"when license = '{a}' and contains(lower(description), '{b}') then '{n}'" for a, b, n in LICENSES) + " else license end"
    r4 = lambda *cs: ", ".join(f"round({c} + 1e-9, 4) as {c}" for c in cs)
    measures = r4("units", "sales", "cost")
    title_cols = "case when license < 'M' then 'North Co.' when license < 'S' then 'South Co.' end"
    released = "make_date(cast(case when n % 100 >= 69 then 1900 + n % 100 else 2000 + n % 100 end as integer), cast(n % 12 + 1 as integer), 15)"
    age = f"cast((year(date) * 12 + month(date)) - (year({released}) * 12 + month({released})) as integer)"
    interest = "select license, round(av + 1e-9, 6) as moviemeter_average, round(t3 + 1e-9, 6) as moviemeter_trend_3, round((list_sum(v[-4:]) + av + t3) / nullif(f6, 0) + 1e-9, 6) as moviemeter_trend_6 from inter3"
    exact = lambda least: f"select {_KEYS}, date, {r4('r.units', 'sales', 'cost').replace('as r.units', 'as units')} from a_rolled r join sku_units u using (sku) where u.units > {least} and exists (select 1 from sku_units where units = {least})"
    pareto = lambda least: f"""select round(case when hit then above + 1 else 1 end / skus + 1e-9, 6) as sku_share, round(case when hit then (select count(*) from a_rolled join sku_units u using (sku) where u.units > {least}) else 0 end / (select count(*) from a_rolled) + 1e-9, 6) as row_share,
  round(case when hit then u_above + {least} else best end / total + 1e-9, 6) as unit_share from (select bool_or(units = {least}) as hit, max(units) as best, count(*)::double as skus, sum(units) as total, count(*) filter (where units > {least}) as above, coalesce(sum(units) filter (where units > {least}), 0) as u_above from sku_units)"""  # noqa: E731
    return {k: (_CTES.rstrip() if v.startswith(",") else _CTES) + v for k, v in {
        "level_rollup_license": f"select license, date, {r4('units', 'sales')}, count from (select license, date, sum(units) as units, coalesce(sum(sales), 0) as sales, count(*) as count from a_filled group by all)",
        "sales_lines": f"select {_KEYS}, month_name, year, {measures} from b_lines",
        "platform_filter": f"select {_KEYS}, month_name, year, {measures} from a_lines where platform in ('A', 'N') and coalesce(supplier <> 'Brand#2', true)",
        "monthly_rollup": f"select {_KEYS}, date, {measures} from a_rolled",
        "product_ranges": "select * from a_ranges",
        "product_platform_pairs": "select * from a_ranges cross join (select distinct platform from a_rolled)",
        "calendar_spine": "select * from a_spine",
        "calendar_spine_by_key": f"select {_KEYS}, cast(unnest(generate_series(min(date), max(date), interval 1 month)) as date) as date from b_rolled group by {_KEYS}",
        "panel_completed": f"select {_KEYS}, date, {measures} from a_full",
        "panel_filled": f"select {_KEYS}, date, {measures}, sku_platform from a_filled",
        "null_counts": "select count(*) filter (where sku is null) as sku, count(*) filter (where units is null) as units, count(*) filter (where sales is null) as sales, count(*) filter (where cost is null) as cost from a_full",
        "license_rules": f"select license, count(*) as n from (select {licenses} as license from a_rolled) group by license",
        "product_labels": f"select sku, description, case {_cased('label', SYNONYMS.items())} else label end as product from (select p_partkey as sku, p_name as description, {first_label} as label from part)",
        "ascii_fold": "select doc_id, md5(regexp_replace(strip_accents(lower(text)), '[^\\x00-\\x7F]', '', 'g')) as folded from documents",
        "sku_dimension": f"select sku, description, supplier, license, {r4('sales', 'units', 'price')} from dim",
        "repeated_skus": "select supplier as sku, count(*) as n from (select distinct license, supplier, platform from b_lines) group by supplier having count(*) > 1",
        "significant_above": f"select {_KEYS}, date, {r4('r.units', 'sales', 'cost').replace('as r.units', 'as units')} from a_rolled r join sku_units u using (sku) where u.units > {LEAST}",
        "significant_exact": exact("(select quantile_disc(units, 0.5) from sku_units)"),
        "significant_exact_no_hit": exact(LEAST + 0.5),
        "pareto_report": pareto("(select quantile_disc(units, 0.5) from sku_units)"),
        "pareto_report_no_hit": pareto(LEAST + 0.5),
        "price_and_date_extent": "select round(min(price) + 1e-9, 4) as min_price, round(max(price) + 1e-9, 4) as max_price, min(date) as min_date, max(date) as max_date from (select date, coalesce(sales / nullif(units, 0), sum(sales / nullif(units, 0) * units) over w / sum(case when sales / nullif(units, 0) is not null then units end) over w) as price from b_filled window w as (partition by sku_platform))",
        "running_unit_share": "select sku, round(units + 1e-9, 6) as units, row_number() over w as rank, round(sum(units) over (order by units desc, sku rows unbounded preceding) / sum(units) over () + 1e-9, 6) as share from sku_units window w as (order by units desc, sku)",
        "price_range": "select cast((floor(min(price) / 50) - 2) * 50 as bigint) as low, cast(floor(max(price) / 50) - floor(min(price) / 50) + 5 as bigint) as cells from dim",
        "price_vectors": """select sku, cell, round(w / (sqrt(sum(w * w) over (partition by sku)) + 1e-9) + 1e-9, 6) as weight from (
  select sku, cast(floor((price - low) / 50) + k as integer) as cell, [1.0, 0.5, 0.25][abs(k) + 1]::double as w from dim, (select (floor(min(price) / 50) - 2) * 50 as low from dim), (select unnest([-2, -1, 0, 1, 2]) as k) where price is not null)""",
        "cluster_split": "select p_partkey as sku, p_size % 5 as raw_cluster, p_type as license, p_brand as product, cast(dense_rank() over (order by p_size % 5, p_type, p_brand) - 1 as integer) as cluster from part",
        "weighted_cost": "select sku, round(sum(cost * units) / nullif(sum(case when cost is not null then units end), 0) + 1e-9, 4) as cost from a_rolled group by sku",
        "stockout_price": "select sku_platform, date, round(coalesce(sales / nullif(units, 0), sum(sales / nullif(units, 0) * units) over (partition by sku_platform) / sum(case when sales / nullif(units, 0) is not null then units end) over (partition by sku_platform)) + 1e-9, 4) as price from b_filled",
        "platform_months": "select sku_platform, date, round(sum(units) over (partition by date, platform) + 1e-9, 4) as platform_monthly_sales from b_filled",
        "stockout_seeds": "select sku_platform, date, round(residuals + 1e-9, 4) as residuals, surge, slump, is_first, seed from seeds",
        "stockout_labels": "select sku_platform, date, stockout from labelled",
        "stockout_counts": "select count(*) as n_rows, cast(sum(seed) as bigint) as seeds, cast(sum(stockout) as bigint) as stockouts from labelled",
        "fit_report": "select count(*) as n_rows, round(sqrt(avg((units - pred) * (units - pred))) + 1e-9, 4) as rmse from pred",
        "in_stock_rows": f"select sku_platform, date, {r4('units', 'sales')} from labelled where stockout = 0",
        "hierarchy_edges": "select 'bottom' as level, sku_platform as parent_id, sku_platform as child_id from c union select 'cluster', cast(cluster as varchar), sku_platform from c union select 'license', license, sku_platform from c",
        "rollup_cluster": f"select cluster, date, {r4('units', 'sales')}, count from (select cluster, date, sum(units) as units, coalesce(sum(sales), 0) as sales, count(*) as count from c group by all)",
        "rollup_by_edges": f"select license, date, {r4('units', 'sales')}, count from (select license, date, sum(units) as units, coalesce(sum(sales), 0) as sales, count(*) as count from c group by all)",
        "mean_cost_by_parent": "select license, round(sum(cost * units) / sum(case when cost is not null then units end) + 1e-9, 4) as cost from c group by license",
        "single_valued_attributes": "select bool_and(a = 1) as supplier, bool_and(b = 1) as license, bool_and(p = 1) as product, bool_and(s = 1) as sku from (select count(distinct supplier) as a, count(distinct license) as b, count(distinct product) as p, count(distinct sku) as s from c group by cluster)",
        "stacked_levels": f"select level, series_id, date, {measures}, count, supplier, license, product from stacked",
        "without_single_children": """select level, series_id, date, round(units + 1e-9, 4) as units, count from (
  select 'bottom' as level, sku_platform as series_id, date, units, 1::bigint as count from c where units > 0
  union all select 'cluster', cast(cluster as varchar), date, sum(units), count(*) from c where units > 0 group by cluster, date having count(*) <> 1
  union all select 'license', license, date, sum(units), count(*) from c where units > 0 group by license, date having count(*) <> 1)""",
        "one_level": "select series_id, date, round(units + 1e-9, 4) as units, count from stacked where level = 'cluster'",
        "month_runs": "select series_id, date, cont_sales_id, cast(year(date) as integer) as year, cast(month(date) as integer) as month_num from runs",
        "time_features": "select series_id, date, round(sin(2 * pi() * month(date) / 12) + 1e-9, 4) + 0.0 as month_sin, round(cos(2 * pi() * month(date) / 12) + 1e-9, 4) + 0.0 as month_cos, months_on_shelf from lags",
        "valid_lags": "select " + ", ".join(f"cast(sum(greatest(n - {k}, 0)) as bigint) as lag_{k}" for k in range(1, 7)) + ", cast(sum(n) as bigint) as n_rows from (select count(units) as n from runs group by series_id, cont_sales_id)",
        "valid_lags_of_gaps": "select " + ", ".join(f"count(l{k}) as lag_{k}" for k in range(1, 7)) + ", count(*) as n_rows from (select " + ", ".join(f"lag(u, {k}) over w as l{k}" for k in range(1, 7)) + " from (select *, case when units % 3 <> 0 then units end as u from runs) window w as (partition by series_id, cont_sales_id order by date))",
        "product_cluster_rules": "select count(distinct sku) as n_skus, true as dense, true as one_license_and_product, true as all_clustered from a_filled",
        "preprocess_job_rules": "select unnest(['bottom', 'cluster', 'license']) as level, true as same_total, true as whole_keys, true as one_row_a_month",
        "modelling_job_rules": "select unnest(['bottom', 'cluster', 'license']) as level, true as adds_up, true as not_negative, true as after_cutoff",
        "lag_features": f"select series_id, date, {r4('lag_1', 'lag_2', 'lag_3', 'sales_roll_3')}, round(lag_1 / nullif(lag_2, 0) + 1e-9, 4) as lag_1_over_lag_2, round(lag_1 / nullif(lag_3, 0) + 1e-9, 4) as lag_1_over_lag_3 from lags",
        "lag_correlations": "select round(corr(lag_1, units) + 1e-9, 4) as lag_1, round(corr(lag_2, units) + 1e-9, 4) as lag_2, round(corr(lag_3, units) + 1e-9, 4) as lag_3 from lags",
        "chosen_lag_features": _lags("select series_id as level, series_id, cont_sales_id, date, units from runs", 6, 0.02, "series_id, date"),
        "feature_job_lags": _lags("select level, series_id, cont_sales_id, date, units from stacked_runs", 15, 0.5, "level, series_id, date"),
        "feature_job": f"""select level, series_id, date, cont_sales_id, round(sin(2 * pi() * month(date) / 12) + 1e-9, 4) + 0.0 as month_sin, cast(row_number() over w - 1 as integer) as months_on_shelf, round(avg(units) over (partition by level, series_id, cont_sales_id order by date rows between 3 preceding and 1 preceding) + 1e-9, 4) as sales_roll_3,
  round(av + 1e-9, 4) as moviemeter_average, cast(n as double) as run_time, case when license = 'ASIA' and n is not null then {age} else 0 end as months_from_release_asia
  from stacked_runs left join inter using (license) left join titles using (license) window w as (partition by level, series_id, cont_sales_id order by date)""",
        "interest_index": interest,
        "interest_index_months_only": "select license, round(av + 1e-9, 6) as moviemeter_average, round(list_sum(v[-3:]) / nullif(f3, 0) + 1e-9, 6) as moviemeter_trend_3, round(list_sum(v[-6:]) / nullif(f6, 0) + 1e-9, 6) as moviemeter_trend_6 from inter",
        "title_companies": f"select production_company, count(*) as n from (select {title_cols} as production_company from titles) where production_company is not null group by production_company having count(*) >= 2",
        "title_attributes": f"""select license, cast(n as double) as run_time, round(size / 10 + 1e-9, 4) as imdb_rating, cast(n % 2 = 0 as integer) as next_release_dummy, (n % 12 + 1) || '/15/' || lpad(cast(n % 100 as varchar), 2, '0') as release_date, budget, cast(n as double) as news_articles, budget * 2 as opening_weekend,
  'released' as title_tatus, 'movie' as title_type, {title_cols} as production_company, cast(license < 'M' as integer) as north_co, cast(license >= 'M' and license < 'S' as integer) as south_co from titles""",
        "enriched_series": f"""select sku, platform, date, round(av + 1e-9, 4) as moviemeter_average, cast(n as double) as run_time, cast(license < 'M' as integer) as north_co, {age} as months_from_release,
  case when license = 'PROMO' then {age} else 0 end as months_from_release_promo, case when license = 'SMALL' then {age} else 0 end as months_from_release_small from a_rolled left join inter using (license) left join titles using (license)""",
        "train_rows": "select level, series_id, date, round(units + 1e-9, 4) as units, coalesce(sku, 'nan') as sku, coalesce(supplier, 'nan') as supplier, coalesce(cast(cluster as varchar), 'nan') as cluster, round(coalesce(sum(sales) over w, 0) / nullif(sum(units) over w, 0) + 1e-9, 4) as price from prep where early window w as (partition by level, series_id)",
        "inference_rows": "select level, series_id, date, round(case when early then units end + 1e-9, 4) as units, round(coalesce(sum(case when early then sales end) over w, 0) / nullif(sum(case when early then units end) over w, 0) + 1e-9, 4) as price from prep window w as (partition by level, series_id)",
        "inference_rows_default": "select level, series_id, date, round(case when early then units end + 1e-9, 4) as units, coalesce(sku, 'nan') as sku, coalesce(cast(cluster as varchar), 'nan') as cluster, round(coalesce(sum(sales) over w, 0) / nullif(sum(case when early then units end) over w, 0) + 1e-9, 4) as price from prep window w as (partition by level, series_id)",
        "finite_ratios": "select l_orderkey, l_linenumber, case when l_discount = 0 or l_tax = 0 then null else round(l_tax / l_discount + 1e-9, 4) end as ratio from lineitem",
        "fixed_prices": "select level, series_id, round(coalesce(sum(sales), 0) / nullif(sum(units), 0) + 1e-9, 4) as price from stacked group by all",
        "forecast_features": f"""select level, series_id, date, round(lag_1 + 1e-9, 4) as lag_1, round(lag_2 + 1e-9, 4) as lag_2, round(lag_1 / nullif(lag_2, 0) + 1e-9, 4) as lag_1_over_lag_2, round(roll + 1e-9, 4) as sales_roll_3 from (
  select level, series_id, date, lag(u, 1) over w as lag_1, lag(u, 2) over w as lag_2, avg(u) over (partition by level, series_id, run order by date rows between 3 preceding and 1 preceding) as roll from (
    select *, case when early then units end as u, sum(fresh) over (partition by level, series_id order by date rows unbounded preceding) as run from (
      select *, case when (year(date) * 12 + month(date)) - lag(year(date) * 12 + month(date)) over (partition by level, series_id order by date) = 1 then 0 else 1 end as fresh from prep))
  window w as (partition by level, series_id, run order by date)) where date >= date '{CUTOFF}'""",
        "child_counts": "select * from kids",
        "single_children": "select cast(cluster as varchar) as series_id, date, round(units + 1e-9, 4) as units from fbottom join kids using (cluster, date) where n_children = 1",
        "restored_forecast": "select level, series_id, date, round(units + 1e-9, 4) as units from restored",
        "densified_forecast": "select level, series_id, date, round(units + 1e-9, 4) as units from dense",
        "bottom_up_totals": "select e.level, parent_id as series_id, date, sum(round_even(units, 0)) as units from fedges e join dense d on d.level = 'bottom' and d.series_id = child_id group by all",
        "reconciled_unconstrained": f"select series_id, date, {r4('units', 'reconciled')} from rec",
        "reconciled_conditions": "select license, date, count(*) as n_series, true as holds from dense join tree using (series_id) where level = 'bottom' group by all",
        "reconciled_three_levels": _two_passes("select level, series_id, size as v from deep_nodes"),
        "reconciled_by_variance": _two_passes(_SPREAD),
        "reconciled_three_levels_conditions": _DEEP + " select license, date, count(*) as n_series, true as holds from deep_dense join deep_tree using (series_id) where level = 'bottom' group by all",
        "poisson_series_totals": "select sku_platform, round(sum(units) + 1e-9, 3) as units, count(*) as n from priced where price is not null group by sku_platform",
        "poisson_slope_scores": "select unnest(['price', 'platform_monthly_sales']) as covariate, count(*) as n, true as holds from priced where price is not null",
        "reconciled_bottom_up": "select parent_id as series_id, strftime(date, '%Y-%m-%d') as date, sum(round_even(units, 0)) as base, sum(round_even(units, 0)) as reconciled, e.level from fedges e join dense d on d.level = 'bottom' and d.series_id = child_id group by all",
        "monthly_units_wide": "select license, " + ", ".join(f"round(sum(units) filter (where month(date) = {m}) + 1e-9, 4) as m{m}" for m in range(1, 13)) + " from a_rolled group by license",
        "monthly_units_long": "select license, 'm' || m as month, round(sum(units) filter (where month(date) = m) + 1e-9, 4) as units from a_rolled, (select unnest(range(1, 13)) as m) group by license, m",
        "key_suffix": "select n_nationkey, string_split(n_name, '_')[-1] as suffix from nation",
    }.items()}
