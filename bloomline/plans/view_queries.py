"""Queries of selections, windows and summaries, and of the helpers that other queries only use inside."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.functions import text
from bloomline.operators import cleaning, profile, views, weekly
from bloomline.plans import weekly_queries as wq
from bloomline.plans.fixtures import history, orders, with_orders
from bloomline.plans.order_queries import PROFILE_SQL
from bloomline.plans.registry import query
from bloomline.sources import tables as sources

CLIENT = "client_code, client"
KEY = wq.KEY
LAST = ", ends as (select max(order_date) as last_date, max(week_start) as last_week from hist)\n"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text, numbers and dates, over whole tables with spellings made from their keys.


@query("normalize_text", "select p_partkey, lower(p_name) as name, 'sin_info' as none from part")
def normalize_text(spark, sf_dir):
    raw = F.concat(F.lit("  "), F.upper(F.regexp_replace("p_name", " ", " \t ")), F.lit("\n"))
    return _table(spark, sf_dir, "part").select("p_partkey", text.normalize_text(raw).alias("name"), text.normalize_text(F.lit(" NaN ")).alias("none"))


@query("strip_accents", "select c_custkey, c_name as name from customer")
def strip_accents(spark, sf_dir):
    raw = F.translate("c_name", "aeou", "áêöü")
    return _table(spark, sf_dir, "customer").select("c_custkey", text.strip_accents(raw).alias("name"))


@query("fix_mojibake", "select c_custkey, replace(c_name, 'o', 'ó') as name from customer")
def fix_mojibake(spark, sf_dir):
    raw = F.decode(F.encode(F.translate("c_name", "o", "ó"), "UTF-8"), "ISO-8859-1")
    return _table(spark, sf_dir, "customer").select("c_custkey", text.fix_mojibake(raw).alias("name"))


@query("normalize_key", "select p_partkey, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '_') as key from part")
def normalize_key(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", text.normalize_key(F.col("p_type")).alias("key"))


@query("combine_key", "select p_partkey, trim(regexp_replace(lower(p_type || '|' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') as key from part")
def combine_key(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", text.combine_key("p_type", "p_brand").alias("key"))


@query("to_number", "select p_partkey, cast(p_retailprice as double) as price, -cast(p_size as double) as size, 0.0::double as none from part")
def to_number(spark, sf_dir):
    price = F.concat(F.lit("$ "), F.translate(F.format_string("%.2f", F.col("p_retailprice").cast("double")), ".", ","))
    size = F.concat(F.lit("-"), F.col("p_size").cast("string"), F.lit(" cm"))
    return _table(spark, sf_dir, "part").select("p_partkey", text.to_number(price).alias("price"), text.to_number(size).alias("size"), text.to_number(F.lit("n/a")).alias("none"))


@query("parse_date", "select o_orderkey, cast(o_orderdate as date) as day from orders")
def parse_date(spark, sf_dir):
    day = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", text.date_from(day, True).alias("day"))


@query("normalize_client_code", "select c_custkey, cast(c_custkey as varchar) as code from customer")
def normalize_client_code(spark, sf_dir):
    code = F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, ".0").otherwise(""))
    return _table(spark, sf_dir, "customer").select("c_custkey", views.normalize_client_code(code).alias("code"))


@query("calendar_columns", with_orders("select distinct order_date, iso_year, iso_week, year_week, month, dow, day_name, week_start from clean"))
def calendar_columns(spark, sf_dir):
    return orders(spark, sf_dir).select("order_date", "iso_year", "iso_week", "year_week", "month", "dow", "day_name", "week_start").distinct()


# Parts of the cleaning.


@query("classify_state", with_orders("select state_canonical, state_category, count(*) as lines from clean group by all"))
def classify_state(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("state_canonical", "state_category").agg(F.count(F.lit(1)).alias("lines"))


@query("order_measures", with_orders(f"select {CLIENT}, sum(stems) as stems, sum(shortfall) as shortfall, avg(fulfilment) as fulfilment, sum(program_boxes) as boxes from clean group by all"))
def order_measures(spark, sf_dir):
    return orders(spark, sf_dir).groupBy(*profile.CLIENT).agg(
        F.sum("stems").alias("stems"), F.sum("shortfall").alias("shortfall"), F.avg("fulfilment").alias("fulfilment"), F.sum("program_boxes").alias("boxes")
    )


@query("add_client_identifiers", with_orders(f"select distinct {CLIENT}, client_key from clean"))
def add_client_identifiers(spark, sf_dir):
    return orders(spark, sf_dir).select(*profile.CLIENT, "client_key").distinct()


KEYS = ["sku_finished", "sku_flexible", "structure_key", "product_color", "product_variety_color", "pack_key", "box_key", "recipe_structure_key", "recipe_program_key"]


@query("operational_keys", with_orders(" union all ".join(f"select '{k}' as name, {k} as key, count(*) as lines from clean group by 2" for k in KEYS)))
def operational_keys(spark, sf_dir):
    long = orders(spark, sf_dir).select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("key")) for k in KEYS])).alias("x"))
    return long.groupBy("x.name", "x.key").agg(F.count(F.lit(1)).alias("lines"))


@query("recipe_program_size", with_orders("select recipe_size_key, count(*) as lines, sum(stems) as stems, max(program_box_stems) as box_stems from clean where order_type in ('RAINBOW', 'BQT', 'BOUQUET', 'COMBO') group by all"))
def recipe_program_size(spark, sf_dir):
    recipes = orders(spark, sf_dir).where(F.col("order_type").isin("RAINBOW", "BQT", "BOUQUET", "COMBO"))
    return recipes.groupBy("recipe_size_key").agg(F.count(F.lit(1)).alias("lines"), F.sum("stems").alias("stems"), F.max("program_box_stems").alias("box_stems"))


@query("operational_sku", with_orders("select order_type, sku_operational, count(*) as lines, sum(stems) as stems from clean group by all"))
def operational_sku(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("order_type", "sku_operational").agg(F.count(F.lit(1)).alias("lines"), F.sum("stems").alias("stems"))


@query("analysis_key", with_orders("select order_type, analysis_key, count(*) as lines from clean group by all"))
def analysis_key(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("order_type", "analysis_key").agg(F.count(F.lit(1)).alias("lines"))


@query("keep_physical_or_value", with_orders("select count(*) as lines, sum(stems) as stems from clean"))
def keep_physical_or_value(spark, sf_dir):
    return orders(spark, sf_dir).agg(F.count(F.lit(1)).alias("lines"), F.sum("stems").alias("stems"))


# Parts of the profile.


@query("minmax_score", with_orders(f""", per as (select {CLIENT}, sum(stems) as stems from hist group by all), e as (select min(stems) as lo, max(stems) as hi from per)
select {CLIENT}, case when lo = hi then case when hi > 0 then 100 else 0 end else (stems - lo) / (hi - lo) * 100 end as score from per, e"""))
def minmax_score(spark, sf_dir):
    per = history(spark, sf_dir).groupBy(*profile.CLIENT).agg(F.sum("stems").alias("stems"))
    return profile.minmax_score(per, ["stems"], low_is_good=False).select(*profile.CLIENT, F.col("minmax_stems").alias("score"))


SCORES = ["score_frequency", "score_volume", "score_color", "score_sku", "score_analysis", "score_pack", "score_type", "score_miss", "score_ease", "score_purchase"]
for _name, _columns in {"client_scores": SCORES, "client_recommendation": ["recommendation"], "client_segment": ["client_segment"]}.items():

    def _profile(spark, sf_dir, columns=_columns):
        return profile.client_profile(history(spark, sf_dir)).select(*profile.CLIENT, *columns)

    query(_name, with_orders(PROFILE_SQL + f"select {CLIENT}, {', '.join(_columns)} from profiles"))(_profile)


# Sources: what is written comes back.


@query("write_tables", with_orders("select iso_year, product, sum(stems) as stems from clean group by all"))
def write_tables(spark, sf_dir):
    path = sources.scratch(spark, "tables")
    sums = orders(spark, sf_dir).groupBy("iso_year", "product", "color").agg(F.sum("stems").alias("stems"))
    sources.write_tables({"sums": sums, "left_out": sums}, path, skip=("left_out",), by={"sums": "iso_year"})
    return spark.read.parquet(f"{path}/sums").groupBy("iso_year", "product").agg(F.sum("stems").alias("stems"))


@query("read_yearly_runs", with_orders("select product, sum(stems) as stems from clean where iso_year = (select max(iso_year) from clean) group by all"))
def read_yearly_runs(spark, sf_dir):
    path = sources.scratch(spark, "runs")
    sums = orders(spark, sf_dir).groupBy(F.col("iso_year").alias("year"), "product").agg(F.sum("stems").alias("stems"))
    sources.write_tables({"runs": sums}, path, by={"runs": "year"})
    return sources.read_yearly_runs(spark, f"{path}/runs").select("product", "stems")


@query("read_columns", "select o_orderkey, o_orderstatus, cast(null as varchar) as not_there from orders")
def read_columns(spark, sf_dir):
    return sources.read_columns(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderstatus", "not_there"])


# Selections and windows.


@query("filter_scope", with_orders("select scope, order_type, count(*) as lines from clean join (values ('solids', ['SOLIDO']), ('structures', ['SURTIDO', 'SURTIDO_M', 'RAINBOW', 'BQT', 'BOUQUET', 'COMBO']), ('bulk', ['BULK']), ('all', null)) s(scope, kinds) on kinds is null or list_contains(kinds, order_type) group by all"))
def filter_scope(spark, sf_dir):
    lines, out = orders(spark, sf_dir), None
    for scope in ("solids", "structures", "bulk", "all"):
        part = views.filter_scope(lines, scope).groupBy("order_type").agg(F.count(F.lit(1)).alias("lines")).withColumn("scope", F.lit(scope))
        out = part if out is None else out.unionByName(part)
    return out


@query("filter_sales", with_orders("select iso_year, country, sum(sales_usd) as sales from clean where iso_week between 10 and 30 and order_type = 'SOLIDO' group by all"))
def filter_sales(spark, sf_dir):
    kept = views.filter_sales(orders(spark, sf_dir), weeks=(10, 30), order_type=["SOLIDO"], country=[])
    return kept.groupBy("iso_year", "country").agg(F.sum("sales_usd").alias("sales"))


@query("filter_general_sales", with_orders("select iso_year, product, sum(sales_usd) as sales, sum(stems) as stems from clean where state_canonical in ('confirmado', 'pendiente') group by all"))
def filter_general_sales(spark, sf_dir):
    kept = views.filter_sales(orders(spark, sf_dir), state_canonical=["confirmado", "pendiente"])
    return kept.groupBy("iso_year", "product").agg(F.sum("sales_usd").alias("sales"), F.sum("stems").alias("stems"))


@query("filter_operational", with_orders("select coalesce(nullif(sku_operational, 'sin_info'), sku_flexible) as visible_sku, sum(stems) as stems from clean where order_type in ('BULK', 'BQT') group by all"))
def filter_operational(spark, sf_dir):
    kept = views.filter_operational(orders(spark, sf_dir), order_type=["BULK", "BQT"])
    return kept.groupBy("visible_sku").agg(F.sum("stems").alias("stems"))


@query("analysis_windows", with_orders(LAST + """, aged as (select *, (last_week - week_start) / 7.0 as age from hist, ends)
select case when age < 12 then 'current' else 'year_before' end as "window", product, sum(stems) as stems from aged where age < 12 or age >= 52 and age < 64 group by all""".replace(", aged", ", aged")))
def analysis_windows(spark, sf_dir):
    return views.analysis_windows(history(spark, sf_dir)).groupBy("window", "product").agg(F.sum("stems").alias("stems"))


@query("future_window", with_orders("select order_date, product, sum(stems) as stems from clean where state_canonical = 'pendiente' and order_date >= (select min(order_date) + 14 from clean where state_canonical = 'pendiente') and order_date < (select min(order_date) + 70 from clean where state_canonical = 'pendiente') group by all"))
def future_window(spark, sf_dir):
    pending = orders(spark, sf_dir).where("state_canonical = 'pendiente'")
    return views.future_window(pending, offset=2).groupBy("order_date", "product").agg(F.sum("stems").alias("stems"))


@query("recent_real_demand", with_orders("select order_date, product, sum(stems) as stems from hist where order_date < (select max(order_date) - 60 from clean) and order_date >= (select max(order_date) - 81 from clean) group by all"))
def recent_real_demand(spark, sf_dir):
    lines = orders(spark, sf_dir)
    horizon = lines.agg(F.date_sub(F.max("order_date"), 60).alias("order_date"))
    return views.recent_real_demand(lines.where("state_canonical = 'confirmado' and stems > 0"), horizon)


@query("sku_summary", with_orders(LAST + f""", w as (select {CLIENT}, sku_operational, year_week, sum(stems) as s, sum(stems_confirmed) as c, count(distinct order_id) as orders from hist, ends where order_date >= last_date - 84 group by all),
p as (select {CLIENT}, sku_operational, sum(s) as stems, count(*) as weeks, cast(sum(orders) as bigint) as orders, median(s) as usual_week, coalesce(sum(c) / nullif(sum(s), 0), 0) as fulfilment from w group by all)
select *, coalesce(stems / nullif(sum(stems) over (partition by {CLIENT}), 0), 0) as share from p"""))
def sku_summary(spark, sf_dir):
    return views.sku_summary(history(spark, sf_dir))


@query("client_structures_12w", with_orders(LAST + f""", m as (select *, order_date >= last_date - 84 as now from hist, ends)
select {CLIENT}, structure_key, sum(stems) as stems, count(distinct year_week) as weeks, sum(case when now then stems else 0 end) as recent_stems, count(distinct case when now then year_week end) as recent_weeks,
  coalesce(sum(stems_confirmed) / nullif(sum(stems), 0), 0) as fulfilment, bool_or(now) as current from m group by all"""))
def client_structures_12w(spark, sf_dir):
    return views.client_structures(history(spark, sf_dir))


@query("typical_week_lookup", with_orders(f", y as (select {CLIENT}, iso_year, sum(stems) as s from hist where iso_week = 20 group by all) select {CLIENT}, count(*) as years, avg(s) as mean_stems, max(s) as most_stems from y group by all"))
def typical_week_lookup(spark, sf_dir):
    return views.typical_week_lookup(history(spark, sf_dir), 20)


@query("week_detail", with_orders(f"select {CLIENT}, product, sum(stems) as stems, count(distinct order_id) as orders from clean where iso_year = 1995 and iso_week = 20 group by all"))
def week_detail(spark, sf_dir):
    return views.week_detail(orders(spark, sf_dir), 1995, 20)


@query("daily_aggregate", with_orders(f"select {CLIENT}, order_date, product, color, order_type, sum(stems) as stems, count(*) as lines from hist group by all"))
def daily_aggregate(spark, sf_dir):
    return views.daily_aggregate(history(spark, sf_dir))


DAILY = ", d as (select product, order_date, sum(stems) as stems from hist group by all)\n"


@query("lag_weeks", with_orders(DAILY + "select d.product, d.order_date, d.stems, " + ", ".join(f"coalesce(l{n}.stems, 0) as lag_{n}w" for n in (1, 2, 4, 8)) + " from d " + " ".join(f"left join d l{n} on l{n}.product = d.product and l{n}.order_date + {7 * n} = d.order_date" for n in (1, 2, 4, 8))))
def lag_weeks(spark, sf_dir):
    return views.lag_weeks(history(spark, sf_dir).groupBy("product", "order_date").agg(F.sum("stems").alias("stems")), ["product"])


@query("category_codes", with_orders(", n as (select product as value, count(*) as n from hist where product <> 'sin_info' group by all), t as (select * from n order by n desc, value limit 178) select value, cast(row_number() over (order by n desc, value) + 1 as integer) as code from t union all select 'sin_info', 1"))
def category_codes(spark, sf_dir):
    return views.category_codes(history(spark, sf_dir), "product")


@query("history_stats", with_orders(", d as (select country, product, color, order_date, sum(stems) as s from hist group by all), e as (select max(order_date) as m from d) select country, product, color, median(s) as median_all, count(*) as days, " + ", ".join(f"median(case when order_date > m - {7 * n} then s end) as median_{n}w" for n in (4, 8, 12, 52)) + " from d, e group by all"))
def history_stats(spark, sf_dir):
    return views.history_stats(history(spark, sf_dir), ["country", "product", "color"])


# Weekly demand and forecasts.


@query("source_summary", with_orders(wq.SOLID + "select count(*) as rows, sum(stems) as stems, min(week_start) as first_week, max(week_start) as last_week, count(distinct client) as clients, count(distinct product) as products from weekly"))
def source_summary(spark, sf_dir):
    return views.source_summary(wq.demand(spark, sf_dir))


@query("filter_forecast", with_orders(wq.NAIVE + f"select {KEY}, week_start, seasonal_naive from naive where market = '05_OTROS' and week_start >= '1996-01-01' and week_start <= '1996-12-31'"))
def filter_forecast(spark, sf_dir):
    kept = views.filter_forecast(wq.naive(spark, sf_dir), "1996-01-01", "1996-12-31", market=["05_OTROS"])
    return kept.select(*weekly.KEY, "week_start", "seasonal_naive")


for _part, _sql in {
    "by_week": "select week_start, sum(stems) as stems, sum(seasonal_naive) as forecast from naive group by all",
    "by_item": "select market, product, color, sum(stems) as stems, sum(seasonal_naive) as forecast from naive group by all",
    "errors": "select market, sum(stems) as stems, sum(seasonal_naive) as forecast, sum(abs(seasonal_naive - stems)) / nullif(sum(stems), 0) as wape from naive group by all",
}.items():

    def _summary(spark, sf_dir, part=_part):
        return views.forecast_summaries(wq.naive(spark, sf_dir), "seasonal_naive")[part]

    query(f"forecast_summaries_{_part}", with_orders(wq.NAIVE + _sql))(_summary)


@query("validation_by_window", with_orders(wq.VALID + """, w as (select iso_year, iso_week, sum(actual) as y, sum(predicted) as p from valid group by all), s as (select *, cast(floor((iso_week - 1) / size) as integer) as win from w, (values (2), (5), (8)) t(size)),
p as (select iso_year, size, win, sum(y) as y, sum(p) as p, count(*) as n from s group by all having count(*) = size)
select iso_year, size, count(*) as windows, sum(y) as actual, sum(p) as predicted, sum(abs(p - y)) / nullif(sum(y), 0) as wape, sum(p - y) / nullif(sum(y), 0) as bias from p group by all"""))
def validation_by_window(spark, sf_dir):
    return views.validation_by_window(weekly.historical_validation(wq.demand(spark, sf_dir)))


@query("apply_calibration", with_orders(wq.NAIVE + f"select {KEY}, week_start, seasonal_naive * case when market = '05_OTROS' then 1.5 else 1 end as seasonal_naive, market = '05_OTROS' as calibrated from naive"))
def apply_calibration(spark, sf_dir):
    factors = spark.range(1).select(F.lit("05_OTROS").alias("market"), F.lit(1.5).alias("factor"))
    return weekly.apply_calibration(wq.naive(spark, sf_dir), factors, "seasonal_naive").select(*weekly.KEY, "week_start", "seasonal_naive", "calibrated")


PEAK = "case when iso_week in (4, 5, 8, 9, 16, 17, 18, 19, 48, 49, 50) then 1 else 0 end"
POST = "case when iso_week in (6, 7, 10, 20, 21, 22, 51, 52) then 1 else 0 end"


def _blend(spark, sf_dir):
    return wq.naive(spark, sf_dir).withColumn("last_year_adjusted", F.col("last_year"))


@query("forecast_hybrid", with_orders(wq.NAIVE + f"select {KEY}, week_start, case when seasonal_naive > 0 then case when {PEAK} = 1 then 0.8 * seasonal_naive + 0.2 * baseline_8w when {POST} = 1 then baseline_8w else 0.4 * seasonal_naive + 0.6 * baseline_8w end else baseline_8w end as hybrid from naive"))
def forecast_hybrid(spark, sf_dir):
    return weekly.forecast_hybrid(_blend(spark, sf_dir), "baseline_8w").select(*weekly.KEY, "week_start", "hybrid")


@query("seasonal_overlay", with_orders(wq.NAIVE + f"select {KEY}, week_start, case when {PEAK} = 1 and seasonal_naive > 0 then 0.75 * seasonal_naive + 0.25 * baseline_8w else baseline_8w end as overlay from naive"))
def seasonal_overlay(spark, sf_dir):
    return weekly.seasonal_overlay(_blend(spark, sf_dir), "baseline_8w").select(*weekly.KEY, "week_start", "overlay")


@query("forecast_scenario", with_orders(wq.NAIVE + "select iso_year, iso_week, sum(activity_8 * baseline_8w) as base, sum(least(activity_8 * 1.2, 1) * baseline_8w * 0.9) as scenario from (select * replace (coalesce(activity_8, 0) as activity_8) from naive) group by all"))
def forecast_scenario(spark, sf_dir):
    predicted = wq.naive(spark, sf_dir).withColumns({"probability": F.col("activity_8"), "volume": F.col("baseline_8w")})
    return weekly.forecast_scenario(predicted, 1.2, 0.9)
