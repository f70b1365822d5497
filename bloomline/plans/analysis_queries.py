"""Queries of the daily forecast, similarity, the interactive analyses, sources and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.operators import analysis, daily, similarity
from bloomline.plans.fixtures import history, orders, with_orders
from bloomline.plans.registry import query

CLIENT = "client_code, client"


def by_segment(df):
    """The coarse fixture: segments as clients, so that days and weeks repeat."""
    return df.withColumns({"client_code": F.col("segment"), "client": F.col("segment")})


SEGMENTS = ", seg as (select * replace (segment as client_code, segment as client) from hist)\n"
STRUCTURE = ", ".join(daily.STRUCTURE)
RECENT = SEGMENTS + f""", flags as (select *, max(order_date) over () as m from seg),
active as (select {CLIENT} from flags group by {CLIENT}, m having max(order_date) >= m - 112 and count(distinct case when order_date >= m - 56 then year_week end) >= 2),
recent as (select * from flags semi join active using ({CLIENT}) where order_date >= m - 56)
"""
BASELINE = RECENT + f""", daily as (select {STRUCTURE}, dow, order_date, sum(stems) as s, max(m) as m from recent group by all),
general as (select {STRUCTURE}, quantile_cont(s, 0.5) as general, count(*) as days, max(m) as m from daily group by all),
same as (select {STRUCTURE}, dow, quantile_cont(s, 0.5) as same, count(*) as same_days from daily group by all),
target as (select *, cast(isodow(demand_date) as integer) as dow from (select * exclude (m), cast(unnest(generate_series(m + 1, m + 7, interval 1 day)) as date) as demand_date from general)),
baseline as (select demand_date, {STRUCTURE}, coalesce(same, general) as stems, case when dow in (select dow from daily) then coalesce(same_days, 0) else days end as same_days, days
  from target left join same using ({STRUCTURE}, dow) where coalesce(same, general) > 0)
"""


@query("active_clients", with_orders(RECENT + f"select distinct {CLIENT} from active"))
def active_clients(spark, sf_dir):
    return daily.active_clients(by_segment(history(spark, sf_dir)))


def forecast(spark, sf_dir):
    return daily.baseline_forecast(by_segment(history(spark, sf_dir)))


@query("baseline_forecast", with_orders(BASELINE + "select * from baseline"))
def baseline_forecast(spark, sf_dir):
    return forecast(spark, sf_dir)


def pending(spark, sf_dir):
    return by_segment(orders(spark, sf_dir).where("state_canonical = 'pendiente'"))


PENDING = f""", pend as (select * replace (segment as client_code, segment as client) from clean where state_canonical = 'pendiente'),
pending_demand as (select order_date as demand_date, {STRUCTURE}, sum(stems) as stems, count(*) as lines, 'PENDIENTE_REAL_CLIENTE' as source, 100.0 as confidence from pend group by all)
"""


@query("pending_as_demand", with_orders(PENDING + "select * from pending_demand"))
def pending_as_demand(spark, sf_dir):
    return daily.pending_as_demand(pending(spark, sf_dir))


@query("combine_demand", with_orders(BASELINE + PENDING + """, rest as (select demand_date, client_code, stems, 'FORECAST_HISTORICO_CONFIRMADO' as source from baseline anti join pending_demand using (demand_date, client_code))
select demand_date, client_code, source, sum(stems) as stems, count(*) as rows from (select demand_date, client_code, stems, source from pending_demand union all select * from rest) group by all"""))
def combine_demand(spark, sf_dir):
    both = daily.combine_demand(daily.pending_as_demand(pending(spark, sf_dir)), forecast(spark, sf_dir))
    return both.groupBy("demand_date", "client_code", "source").agg(F.sum("stems").alias("stems"), F.count(F.lit(1)).alias("rows"))


@query("forecast_vs_actual", with_orders(BASELINE + f""", f as (select demand_date, {CLIENT}, product, color, sum(stems) as predicted from baseline group by all),
a as (select order_date as demand_date, {CLIENT}, product, color, sum(stems) as actual from (select * replace (segment as client_code, segment as client) from clean where state_canonical <> 'confirmado') group by all),
b as (select demand_date, {CLIENT}, product, color, coalesce(predicted, 0) as predicted, coalesce(actual, 0) as actual from f full join a using (demand_date, {CLIENT}, product, color))
select *, predicted - actual as difference, abs(predicted - actual) as error, case when actual > 0 then abs(predicted - actual) / actual end as error_pct,
  case when predicted > actual then 'SOBRE_ESTIMA' when predicted < actual then 'SUB_ESTIMA' else 'OK' end as bias, predicted > 0 and actual > 0 as matched from b"""))
def forecast_vs_actual(spark, sf_dir):
    return daily.forecast_vs_actual(forecast(spark, sf_dir), by_segment(orders(spark, sf_dir).where("state_canonical <> 'confirmado'")))


@query("client_share_matrix", with_orders(f""", per as (select {CLIENT}, color as item, sum(stems) as s from hist group by all), top as (select item from per group by item order by sum(s) desc, item limit 5)
select {CLIENT}, item, coalesce(s / nullif(sum(s) over (partition by {CLIENT}), 0), 0) as share from per semi join top using (item)"""))
def client_share_matrix(spark, sf_dir):
    return similarity.client_share_matrix(history(spark, sf_dir), "color", 5)


def _unit(column: str, weight: float) -> str:
    return f"""select '{column}' as space, item, client_code, client, coalesce(share / nullif(sqrt(sum(share * share) over (partition by client_code, client)), 0), 0) * sqrt({weight}) as u from (
  select client_code, client, item, s / sum(s) over (partition by client_code, client) as share from (select client_code, client, {column} as item, sum(stems) as s from hist group by all)
  where item in (select {column} from hist group by {column} order by sum(stems) desc, {column} limit 300))"""


@query("client_similarity", with_orders(", units as (" + " union all ".join(_unit(c, w) for c, w in similarity.WEIGHTS.items()) + """),
met as (select a.client_code, a.client, b.client_code as similar_code, b.client as similar_client, round(sum(a.u * b.u), 9) as total from units a join units b using (space, item)
  where a.client_code <> b.client_code or a.client <> b.client group by all),
best as (select client_code, client, similar_code, similar_client, round_even(total, 4) as similarity
  from (select *, row_number() over (partition by client_code, client order by total desc, similar_code, similar_client) as place from met) where place <= 10 and total > 0)
select *, case when similarity >= 0.8 then 'ALTA_COMPATIBILIDAD_TERMINADO' when similarity >= 0.65 then 'COMPATIBLE_PARA_PILOTO' when similarity >= 0.5 then 'COMPATIBLE_SOLO_COLOR_BASE' else 'BAJA_COMPATIBILIDAD' end as compatibility from best"""))
def client_similarity(spark, sf_dir):
    return similarity.client_similarity(history(spark, sf_dir))


BANDS = f""", weeks as (select {CLIENT}, year_week, sum(stems) as stems from hist group by all),
bands as (select w.*, q25, median, q75, weeks from weeks w join (select {CLIENT}, quantile_cont(stems, 0.25) as q25, quantile_cont(stems, 0.5) as median, quantile_cont(stems, 0.75) as q75, count(*) as weeks from weeks group by all) using ({CLIENT})),
marked as (select *, case when stems between greatest(q25 - 1.5 * (q75 - q25), median * 0.45) and least(q75 + 1.5 * (q75 - q25), median * 1.75) then 1 else 0 end as inside from bands),
regular as (select {CLIENT}, year_week, stems from (select *, sum(inside) over (partition by {CLIENT}) as kept from marked) where weeks < 4 or median <= 0 or kept < greatest(2, least(4, weeks // 2)) or inside = 1)
"""


@query("regular_weeks", with_orders(BANDS + "select * from regular"))
def regular_weeks(spark, sf_dir):
    return analysis.regular_weeks(history(spark, sf_dir))


@query("week_classification", with_orders(BANDS + f"""select {CLIENT}, year_week, stems, case when stems >= greatest(q75 * 1.35, median * 1.5) then 'PICO' when stems <= q25 * 0.65 then 'ATIPICA_BAJA'
  when coalesce(abs(stems - median) / nullif(median, 0) <= 0.25, true) then 'NORMAL' else 'VARIABLE' end as week_class from bands"""))
def week_classification(spark, sf_dir):
    return analysis.week_classification(history(spark, sf_dir))


FLAGS = ", flags as (select *, order_date >= max(order_date) over () - 84 as in12, order_date >= max(order_date) over () - 28 as in4 from hist)\n"


@query("client_trend", with_orders(FLAGS + f""", per as (select {CLIENT}, sum(case when in12 then stems else 0 end) / greatest(count(distinct case when in12 then year_week end), 1) as mean_12w,
    sum(case when in4 then stems else 0 end) / greatest(count(distinct case when in4 then year_week end), 1) as mean_4w,
    coalesce(sum(case when order_type = 'SOLIDO' then stems else 0 end) / nullif(sum(stems), 0), 0) as solid_share,
    coalesce(sum(case when order_type in ('SURTIDO', 'SURTIDO_M', 'RAINBOW', 'BOUQUET', 'BQT', 'COMBO') then stems else 0 end) / nullif(sum(stems), 0), 0) as mixed_share from flags group by all)
select *, case when mean_4w > mean_12w * 1.15 then 'SUBE' when mean_4w < mean_12w * 0.85 then 'BAJA' else 'ESTABLE' end as trend,
  case when solid_share >= 0.55 then 'SOLIDOS_RECURRENTES' when mixed_share >= 0.45 then 'MEZCLA_COLOR_COMPOSICION' else 'COLOR_BASE_O_MANUAL' end as advice from per"""))
def client_trend(spark, sf_dir):
    return analysis.client_trend(history(spark, sf_dir))


@query("window_comparison", with_orders(FLAGS + f""", colors as (select {CLIENT}, color, sum(stems) as a, sum(case when in12 then stems else 0 end) as b, sum(case when in4 then stems else 0 end) as c from flags group by all),
top as (select {CLIENT}, arg_max(color, (a, color)) as color_always, arg_max(color, (b, color)) as color_in12, arg_max(color, (c, color)) as color_in4 from colors group by all),
means as (select {CLIENT}, sum(stems) / count(distinct year_week) as mean_always, coalesce(sum(case when in12 then stems else 0 end) / nullif(count(distinct case when in12 then year_week end), 0), 0) as mean_in12,
    coalesce(sum(case when in4 then stems else 0 end) / nullif(count(distinct case when in4 then year_week end), 0), 0) as mean_in4 from flags group by all)
select *, (mean_in4 - mean_in12) / nullif(mean_in12, 0) as change from means join top using ({CLIENT})"""))
def window_comparison(spark, sf_dir):
    return analysis.window_comparison(history(spark, sf_dir))


@query("ranked_dimension", with_orders(BANDS + f""", kept as (select * from hist semi join regular using ({CLIENT}, year_week))
select color, sum(stems) as stems, sum(stems) / (select count(distinct year_week) from kept) as week_mean, sum(stems) / (select sum(stems) from kept) as share from kept group by color order by week_mean desc, color limit 5"""))
def ranked_dimension(spark, sf_dir):
    return analysis.ranked_dimension(history(spark, sf_dir), "color", 5)


@query("yoy_change_chain", with_orders("select *, (stems - stems_before) / nullif(stems_before, 0) as change from (select *, lag(stems) over (partition by product order by iso_year) as stems_before from (select product, iso_year, sum(stems) as stems, sum(sales_usd) as sales_usd from hist group by all))"))
def yoy_change_chain(spark, sf_dir):
    return analysis.yoy_change_chain(history(spark, sf_dir), ["product"])


@query("year_over_year", with_orders("""select *, stems_other - stems_base as delta_stems, (stems_other - stems_base) / nullif(stems_base, 0) as delta_stems_pct, usd_other - usd_base as delta_usd, (usd_other - usd_base) / nullif(usd_base, 0) as delta_usd_pct,
  stems_other / nullif(sum(stems_other) over (), 0) as share from (select product, sum(case when iso_year = 1996 then stems_confirmed else 0 end) as stems_base, sum(case when iso_year = 1997 then stems_confirmed else 0 end) as stems_other,
  sum(case when iso_year = 1996 then sales_usd else 0 end) as usd_base, sum(case when iso_year = 1997 then sales_usd else 0 end) as usd_other from hist where iso_year in (1996, 1997) group by all)"""))
def year_over_year(spark, sf_dir):
    return analysis.year_over_year(history(spark, sf_dir), 1996, 1997)


@query("product_mix_top", with_orders(""", per as (select color, sum(stems_confirmed) as stems, sum(sales_usd) as sales_usd from hist group by all), top as (select color from per order by stems desc, color limit 4)
select case when color in (select color from top) then color else 'Otros' end as color, sum(stems) as stems, sum(sales_usd) as sales_usd from per group by 1"""))
def product_mix_top(spark, sf_dir):
    return analysis.mix_top(history(spark, sf_dir), "color", 4)


for _name, _keys in {"monthly_sales_by_year": ["iso_year", "month"], "weekly_by_year": ["iso_year", "iso_week"], "price_by_year": ["iso_year", "currency"], "sales_rollup": ["iso_year", "client_code", "product"]}.items():
    _list = ", ".join(_keys)
    query(_name, with_orders(f"select *, coalesce(sales_usd / nullif(confirmed, 0), 0) as price_usd from (select {_list}, sum(stems_confirmed) as confirmed, sum(sales_usd) as sales_usd, count(distinct order_id) as orders from hist group by all)"))(
        lambda spark, sf_dir, keys=_keys: analysis.sales_by_period(history(spark, sf_dir), keys)
    )


@query("facet_values", with_orders("select color as value, sum(stems) as stems, count(*) as lines from hist where order_type in ('SOLIDO', 'BULK') group by all"))
def facet_values(spark, sf_dir):
    return analysis.facet_values(history(spark, sf_dir), "color", {"order_type": ["SOLIDO", "BULK"]})


@query("sku_ranking", with_orders("select sku_operational, order_type, sum(stems) as stems, count(distinct client_code) as clients, count(distinct year_week) as weeks, sum(sales_usd) as sales_usd, sum(stems) / (select sum(stems) from hist) as share from hist group by sku_operational, order_type order by stems desc, sku_operational, order_type limit 20"))
def sku_ranking(spark, sf_dir):
    return analysis.sku_ranking(history(spark, sf_dir))


@query("recent_sku_history", with_orders(f""", ago as (select *, (max(week_start) over () - week_start) // 7 as ago from hist),
r as (select {CLIENT}, sku_operational, {', '.join(f'sum(case when ago = {k} then stems else 0 end) as week_{k}' for k in range(4))}, sum(stems) / 12 as mean_12w from ago where ago < 12 group by all)
select *, (week_0 - mean_12w) / nullif(mean_12w, 0) as variation from r"""))
def recent_sku_history(spark, sf_dir):
    return analysis.recent_sku_history(history(spark, sf_dir))


@query("color_composition", with_orders("select *, coalesce(stems / nullif(sum(stems) over (partition by sku_operational), 0), 0) as share from (select sku_operational, color, sum(stems) as stems from hist group by all)"))
def color_composition(spark, sf_dir):
    return analysis.color_composition(history(spark, sf_dir), ["sku_operational"])


@query("regular_order", with_orders(f"select * from (select *, row_number() over (partition by {CLIENT} order by times desc, sku_operational) as place from (select {CLIENT}, sku_operational, count(distinct (order_date, order_id)) as times, sum(stems) as stems from hist group by all)) where place <= 3"))
def regular_order(spark, sf_dir):
    return analysis.regular_order(history(spark, sf_dir))


@query("price_summary", with_orders(f""", c as (select {CLIENT}, currency, count(*) as n from hist group by all), m as (select {CLIENT}, min(currency) as currency from c join (select {CLIENT}, max(n) as n from c group by all) using ({CLIENT}, n) group by all)
select p.*, currency, coalesce(sales_usd / nullif(stems, 0), 0) as price_usd, coalesce(total_value / nullif(stems, 0), 0) as price_original from (select {CLIENT}, sum(stems) as stems, sum(sales_usd) as sales_usd, sum(total_value) as total_value from hist group by all) p join m using ({CLIENT})"""))
def price_summary(spark, sf_dir):
    return analysis.price_summary(history(spark, sf_dir))


@query("weekly_demand_stream", "select cast(date_trunc('week', ts) as date) as week_start, user_id, event_type, sum(value) as stems, count(*) as lines from events group by all")
def weekly_demand_stream(spark, sf_dir):
    from bloomline.streaming.orders import run_to_table, weekly_demand_stream

    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return run_to_table(weekly_demand_stream(source), "complete")


@query("read_orders_csv", with_orders("select order_id, client_code, product, color, sum(stems) as stems, count(*) as lines from clean group by all"))
def read_orders_csv(spark, sf_dir):
    from bloomline.operators.cleaning import clean_orders
    from bloomline.plans.fixtures import raw_orders
    from bloomline.sources.tables import read_orders_csv, scratch, write_tables

    path = scratch(spark, "orders-csv")
    write_tables({"orders": raw_orders(spark, sf_dir)}, path, "csv")
    lines = clean_orders(read_orders_csv(spark, f"{path}/orders"))
    return lines.groupBy("order_id", "client_code", "product", "color").agg(F.sum("stems").alias("stems"), F.count(F.lit(1)).alias("lines"))
