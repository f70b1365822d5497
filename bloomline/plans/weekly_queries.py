"""Queries of the weekly forecast, over the coarse fixture: segments as clients, so that weeks repeat."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bloomline.operators import cleaning, importance
from bloomline.operators import weekly as ops
from bloomline.plans.fixtures import market_sql, orders, with_orders
from bloomline.plans.registry import query
from bloomline.sources.tables import stored


def lines(spark, sf_dir):
    solid = orders(spark, sf_dir).where("order_type = 'SOLIDO' and stems > 0")
    return solid.drop("client", "market").withColumns({"client": F.col("segment"), "market": cleaning.classify_market(F.col("country"))})


def demand(spark, sf_dir):
    return ops.solid_weekly_demand(lines(spark, sf_dir))


KEY = ", ".join(ops.KEY)
SOLID = f", solid as (select * replace (segment as client), {market_sql('country')} as market from clean where order_type = 'SOLIDO' and stems > 0),\nweekly as (select {KEY}, week_start, iso_year, iso_week, sum(stems) as stems, sum(stems_confirmed) as confirmed, sum(shortfall) as shortfall, count(*) as lines from solid group by all)\n"
PANEL = SOLID + f""", ends as (select min(week_start) as a, max(week_start) as b from weekly),
strong as (select {KEY} from weekly group by all having (count(distinct week_start) >= 3 or sum(stems) >= 500) and max(week_start) >= (select b - 357 from ends)),
dense as (select {KEY}, cast(unnest(generate_series(a, b, interval 7 day)) as date) as week_start from strong, ends),
panel as (select d.*, coalesce(w.stems, 0) as stems, cast(isoyear(d.week_start) as integer) as iso_year, cast(week(d.week_start) as integer) as iso_week, cast(month(d.week_start) as integer) as month
  from dense d left join weekly w using ({KEY}, week_start))
"""
FEATURES = PANEL + f""", lagged as (select *, lag(stems, 1) over w as lag_1, lag(stems, 2) over w as lag_2, lag(stems, 4) over w as lag_4,
    avg(stems) over (w rows between 4 preceding and 1 preceding) as mean_4, quantile_cont(stems, 0.5) over (w rows between 8 preceding and 1 preceding) as median_8,
    quantile_cont(stems, 0.5) over (w rows between 12 preceding and 1 preceding) as median_12,
    avg(case when stems > 0 then 1.0 else 0 end) over (w rows between 8 preceding and 1 preceding) as activity_8,
    avg(case when stems > 0 then 1.0 else 0 end) over (w rows between 26 preceding and 1 preceding) as activity_26
  from panel window w as (partition by {KEY} order by week_start))
"""


@query("select_solids", with_orders("select client_code, product, color, sum(stems) as stems, count(*) as lines from clean where order_type = 'SOLIDO' and state_canonical = 'confirmado' group by all"))
def select_solids(spark, sf_dir):
    return ops.select_solids(orders(spark, sf_dir)).groupBy("client_code", "product", "color").agg(F.sum("stems").alias("stems"), F.count(F.lit(1)).alias("lines"))


@query("solid_weekly_demand", with_orders(SOLID + "select * from weekly"))
def solid_weekly_demand(spark, sf_dir):
    return demand(spark, sf_dir)


def panel(spark, sf_dir):
    return ops.week_panel(demand(spark, sf_dir))


@query("week_panel", with_orders(PANEL + "select * from panel"))
def week_panel(spark, sf_dir):
    return panel(spark, sf_dir)


@query("floral_calendar", with_orders(SOLID + """select iso_week, case when iso_week = 4 then 'PRE_SAN_VALENTIN' when iso_week = 5 then 'PICO_SAN_VALENTIN' when iso_week in (6, 7) then 'POST_SAN_VALENTIN'
  when iso_week = 8 then 'PRE_DIA_MUJER' when iso_week = 9 then 'PICO_DIA_MUJER' when iso_week = 10 then 'POST_DIA_MUJER' when iso_week in (16, 17) then 'PRE_MADRES' when iso_week in (18, 19) then 'PICO_MADRES'
  when iso_week in (20, 21, 22) then 'POST_MADRES' when iso_week = 48 then 'PRE_FIN_ANO' when iso_week in (49, 50) then 'PICO_FIN_ANO' when iso_week in (51, 52) then 'POST_FIN_ANO' else 'REGULAR' end as phase,
  case when iso_week in (4, 5, 8, 9, 16, 17, 18, 19, 48, 49, 50) then 1 else 0 end as is_peak, case when iso_week in (6, 7, 10, 20, 21, 22, 51, 52) then 1 else 0 end as is_post,
  least(abs(iso_week - 5), abs(iso_week - 9), abs(iso_week - 18), abs(iso_week - 19), abs(iso_week - 49), abs(iso_week - 50)) as peak_distance, sum(stems) as stems from weekly group by all"""))
def floral_calendar(spark, sf_dir):
    return demand(spark, sf_dir).groupBy("iso_week").agg(F.sum("stems").alias("stems")).withColumns(ops.floral_calendar(F.col("iso_week")))


@query("market_year_growth", with_orders(SOLID + """select market, iso_year + 1 as iso_year, case when p is not null and p <> 0 then least(greatest(s / p, 0.75), 1.35) end as growth
  from (select *, lag(s) over (partition by market order by iso_year) as p from (select market, iso_year, sum(stems) as s from weekly group by all))"""))
def market_year_growth(spark, sf_dir):
    return ops.market_year_growth(demand(spark, sf_dir))


LAGGED = [*ops.KEY, "week_start", "stems", *ops.FROZEN, *ops.ROLLING]


FULL = FEATURES + f""", seen as (select * from panel where stems > 0),
kl as (select {KEY}, quantile_cont(stems, 0.5) as key_median, count(*) as key_weeks from seen group by all), ci as (select client, product, color, quantile_cont(stems, 0.5) as client_item_median from seen group by all),
mw as (select market, product, color, iso_week, quantile_cont(stems, 0.5) as market_week_median from seen group by all), cw as (select client, count(distinct week_start) as client_weeks from seen group by all),
gy as (select market, iso_year + 1 as iso_year, case when p is not null and p <> 0 then least(greatest(s / p, 0.75), 1.35) end as growth from (select *, lag(s) over (partition by market order by iso_year) as p from (select market, iso_year, sum(stems) as s from seen group by all))),
tw as (select market, product, color, iso_year, iso_week, sum(stems) as s from panel group by all), wl as (select market, product, color, iso_week, quantile_cont(s, 0.5) as week_level from tw group by all),
bl as (select market, product, color, quantile_cont(s, 0.5) as base_level from tw group by all),
si as (select market, product, color, iso_week, case when base_level <> 0 then least(greatest(week_level / base_level, 0), 5) end as season_index from wl join bl using (market, product, color)),
py as (select {KEY}, iso_year + 1 as iso_year, iso_week, stems as last_year from panel),
full_features as (select {KEY}, week_start, iso_year, iso_week, month, stems, {', '.join(f'coalesce({c}, 0) as {c}' for c in [*ops.FROZEN, *ops.ROLLING])}, coalesce(last_year, 0) as last_year, coalesce(key_median, 0) as key_median,
    cast(coalesce(key_weeks, 0) as double) as key_weeks, coalesce(client_item_median, 0) as client_item_median, coalesce(market_week_median, 0) as market_week_median, cast(coalesce(client_weeks, 0) as double) as client_weeks,
    coalesce(growth, 1) as growth, coalesce(season_index, 1) as season_index
  from lagged left join py using ({KEY}, iso_year, iso_week) left join kl using ({KEY}) left join ci using (client, product, color) left join mw using (market, product, color, iso_week)
  left join cw using (client) left join gy using (market, iso_year) left join si using (market, product, color, iso_week))
"""


@query("panel_features", with_orders(FULL + """select *, last_year * growth as last_year_adjusted, round(sin(2 * pi() * iso_week / 52), 9) + 0 as week_sin, round(cos(2 * pi() * iso_week / 52), 9) + 0 as week_cos, round(sin(2 * pi() * month / 12), 9) + 0 as month_sin, round(cos(2 * pi() * month / 12), 9) + 0 as month_cos,
  case when iso_week in (4, 5, 8, 9, 16, 17, 18, 19, 48, 49, 50) then 1 else 0 end as is_peak, case when iso_week in (6, 7, 10, 20, 21, 22, 51, 52) then 1 else 0 end as is_post,
  least(abs(iso_week - 5), abs(iso_week - 9), abs(iso_week - 18), abs(iso_week - 19), abs(iso_week - 49), abs(iso_week - 50)) as peak_distance from full_features"""))
def panel_features(spark, sf_dir):
    turns = {c: F.round(c, 9) + 0.0 for c in ("week_sin", "week_cos", "month_sin", "month_cos")}
    return ops.panel_features(panel(spark, sf_dir)).drop("phase").withColumns(turns)


@query("freeze_recent", with_orders(PANEL + f""", back as (select *, row_number() over (partition by {KEY} order by week_start desc) as k from panel where week_start <= (select b - 56 from ends)),
anchor as (select {KEY}, max(case when k = 1 then stems end) as lag_1, max(case when k = 2 then stems end) as lag_2, max(case when k = 4 then stems end) as lag_4, avg(case when k <= 4 then stems end) as mean_4,
    quantile_cont(case when k <= 8 then stems end, 0.5) as median_8, quantile_cont(case when k <= 12 then stems end, 0.5) as median_12,
    avg(case when k <= 8 then case when stems > 0 then 1.0 else 0 end end) as activity_8, avg(case when k <= 26 then case when stems > 0 then 1.0 else 0 end end) as activity_26 from back group by all)
select p.{KEY.replace(', ', ', p.')}, week_start, stems, {', '.join(f'coalesce({c}, 0) as {c}' for c in [*ops.FROZEN, *ops.ROLLING])} from panel p left join anchor using ({KEY}) where week_start > (select b - 56 from ends)"""))
def freeze_recent(spark, sf_dir):
    train, test = ops.split_weeks(panel(spark, sf_dir))
    return ops.freeze_recent(test, train).select(*LAGGED)


def naive(spark, sf_dir):
    return ops.forecast_seasonal_naive(ops.forecast_baseline_8w(ops.panel_features(panel(spark, sf_dir))))


NAIVE = FEATURES + f""", seen as (select * from panel where stems > 0), item as (select client, product, color, quantile_cont(stems, 0.5) as m from seen group by all),
past as (select {KEY}, iso_year + 1 as iso_year, iso_week, stems as last_year from panel),
naive as (select l.*, coalesce(nullif(median_8, 0), nullif(median_12, 0), nullif(m, 0), 0) as baseline_8w, coalesce(last_year, 0) as seasonal_naive
  from lagged l left join item using (client, product, color) left join past using ({KEY}, iso_year, iso_week))
"""


@query("forecast_baseline_8w", with_orders(NAIVE + f"select {KEY}, week_start, stems, baseline_8w from naive"))
def forecast_baseline_8w(spark, sf_dir):
    return naive(spark, sf_dir).select(*ops.KEY, "week_start", "stems", "baseline_8w")


@query("forecast_seasonal_naive", with_orders(NAIVE + f"select {KEY}, week_start, stems, seasonal_naive from naive"))
def forecast_seasonal_naive(spark, sf_dir):
    return naive(spark, sf_dir).select(*ops.KEY, "week_start", "stems", "seasonal_naive")


@query("forecast_metrics", with_orders(NAIVE + """, long as (select market, stems as y, 'baseline_8w' as model, baseline_8w as p from naive union all select market, stems, 'seasonal_naive', seasonal_naive from naive)
select market, model, avg(abs(p - y)) as mae, sqrt(avg((p - y) * (p - y))) as rmse, sum(abs(p - y)) / nullif(sum(abs(y)), 0) as wape, avg(case when y <> 0 then abs((p - y) / y) end) as mape_nonzero, sum(p - y) / nullif(sum(y), 0) as bias from long group by all"""))
def forecast_metrics(spark, sf_dir):
    return ops.forecast_metrics(naive(spark, sf_dir), ["baseline_8w", "seasonal_naive"], keys=("market",))


@query("wape_by_grain", with_orders(NAIVE + "select sum(abs(p - y)) / nullif(sum(abs(y)), 0) as wape, count(*) as groups from (select market, product, week_start, sum(stems) as y, sum(baseline_8w) as p from naive group by all)"))
def wape_by_grain(spark, sf_dir):
    return ops.wape_by_grain(naive(spark, sf_dir), ["market", "product", "week_start"], "baseline_8w")


VALID = SOLID + f""", now as (select {KEY}, iso_year, iso_week, sum(stems) as actual from weekly group by all),
valid as (select {KEY}, iso_year, iso_week, coalesce(actual, 0) as actual, coalesce(predicted, 0) as predicted from now full join (select {KEY}, iso_year + 1 as iso_year, iso_week, actual as predicted from now) using ({KEY}, iso_year, iso_week)
  where iso_year > (select min(iso_year) from weekly) and iso_year <= (select max(iso_year) from weekly))
"""


@query("historical_validation", with_orders(VALID + "select * from valid"))
def historical_validation(spark, sf_dir):
    return ops.historical_validation(demand(spark, sf_dir))


@query("validation_by_year", with_orders(VALID + "select market, iso_year, sum(actual) as actual, sum(predicted) as predicted, sum(abs(predicted - actual)) / nullif(sum(actual), 0) as wape, sum(predicted - actual) / nullif(sum(actual), 0) as bias from valid group by all"))
def validation_by_year(spark, sf_dir):
    return ops.validation_by_year(ops.historical_validation(demand(spark, sf_dir)))


@query("market_calibration", with_orders(NAIVE + """, w as (select market, week_start, sum(stems) as y, sum(seasonal_naive) as p from naive group by all), h as (select *, ntile(2) over (partition by market order by week_start) as half from w)
select *, case when first >= 1.05 and second >= 1.05 and stems >= 100000 then least(greatest(whole, 1), 2) else 1 end as factor from (select market, sum(y) filter (where half = 1) / nullif(sum(p) filter (where half = 1), 0) as first,
  sum(y) filter (where half = 2) / nullif(sum(p) filter (where half = 2), 0) as second, sum(y) / nullif(sum(p), 0) as whole, sum(y) as stems from h group by all)"""))
def market_calibration(spark, sf_dir):
    return ops.market_calibration(naive(spark, sf_dir), "seasonal_naive")


@query("forecast_backtest")
def forecast_backtest(spark, sf_dir):
    return ops.forecast_backtest(panel(spark, sf_dir))


# What the models go by.


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    """Models of 10 trees on all weeks but the last eight, their importance on those."""
    featured = stored(ops.panel_features(panel(spark, sf_dir)), "importance-features")
    train, test = ops.split_weeks(featured)
    return importance.permutation_importance(ops.fit_two_stage(train, trees=10), test)


DRIVERS = """, told as (select order_type as stage, market, color as variable, sum(stems) as s from (select order_type, market, color, stems from solid_all union all select order_type, 'TODOS', color, stems from solid_all) group by all),
shares as (select stage, market, variable, s / sum(s) over (partition by stage, market) - 0.12 as importance from told)
"""


@query("forecast_top_drivers", with_orders(f", solid_all as (select *, {market_sql('country')} as market from clean where stems > 0)" + DRIVERS + """select stage, market, variable, importance, cast(place as integer) as place
  from (select *, row_number() over (partition by stage, market order by importance desc, variable) as place from shares where importance > 0) where place <= case when market = 'TODOS' then 4 else 2 end"""))
def forecast_top_drivers(spark, sf_dir):
    """The choice, from a table of figures by order type, market and colour in the form of an importance table."""
    df = orders(spark, sf_dir).where("stems > 0").withColumn("market", cleaning.classify_market(F.col("country")))
    both = df.select("order_type", "color", "stems", F.explode(F.array(F.col("market"), F.lit(importance.ALL))).alias("market"))
    per = both.groupBy(F.col("order_type").alias("stage"), "market", F.col("color").alias("variable")).agg(F.sum("stems").alias("s"))
    share = F.col("s") / F.sum("s").over(Window.partitionBy("stage", "market")) - 0.12
    return importance.forecast_top_drivers(per.select("stage", "market", "variable", share.alias("importance")))
