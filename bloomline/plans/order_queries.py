"""Queries of cleaning, profiles, mixes and sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.operators import cleaning, mix, profile
from bloomline.plans.fixtures import history, inventory, market_sql, orders, with_inventory, with_orders
from bloomline.plans.registry import query

CLEAN_COLUMNS = [
    "order_date", "client_code", "client", "client_key", "order_id", "state_canonical", "state_category", "product", "variety",
    "color", "grade", "order_type", "order_subtype", "focus", "color_role", "family", "stems", "stems_confirmed", "shortfall",
    "fulfilment", "iso_year", "iso_week", "year_week", "month", "dow", "day_name", "week_start", "stems_per_bunch", "sku_finished",
    "sku_flexible", "structure_key", "product_color", "product_variety_color", "pack_key", "box_key", "recipe_structure_key",
    "recipe_program_key", "program_box_stems", "program_bunches", "program_bunch_stems", "recipe_size_key", "sku_composition",
    "analysis_key", "sku_operational", "sales_usd", "total_value",
]


@query("clean_orders", with_orders(f"select {', '.join(CLEAN_COLUMNS)} from clean"))
def clean_orders(spark, sf_dir):
    return orders(spark, sf_dir).select(*CLEAN_COLUMNS)


@query("clean_inventory", with_inventory("select * from inv"))
def clean_inventory(spark, sf_dir):
    return inventory(spark, sf_dir)


@query("state_summary", with_orders("select state_canonical, state_category, count(*) as lines, count(distinct client_code) as clients, sum(stems) as stems, min(order_date) as date_min, max(order_date) as date_max from clean group by all"))
def state_summary(spark, sf_dir):
    return cleaning.state_summary(orders(spark, sf_dir))


@query("classify_market", with_orders(f"select country, {market_sql('country')} as market, count(*) as lines, count(distinct client_code) as clients from clean group by all"))
def classify_market(spark, sf_dir):
    placed = orders(spark, sf_dir).withColumn("market", cleaning.classify_market(F.col("country")))
    return placed.groupBy("country", "market").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("client_code").alias("clients"))


@query("classify_order_type", with_orders("select pack_order_type, order_type, order_subtype, focus, color_role, family, count(*) as lines from clean group by all"))
def classify_order_type(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("pack_order_type", "order_type", "order_subtype", "focus", "color_role", "family").agg(F.count(F.lit(1)).alias("lines"))


@query("filter_years", with_orders("select year_week, count(*) as lines, sum(stems) as stems from clean where year(order_date) in (1997, 1998) group by all"))
def filter_years(spark, sf_dir):
    return cleaning.filter_years(orders(spark, sf_dir), [1997, 1998]).groupBy("year_week").agg(F.count(F.lit(1)).alias("lines"), F.sum("stems").alias("stems"))


@query("confirmed_history", with_orders("select order_type, count(*) as lines, sum(stems) as stems from hist group by all"))
def confirmed_history(spark, sf_dir):
    return cleaning.confirmed_history(orders(spark, sf_dir)).groupBy("order_type").agg(F.count(F.lit(1)).alias("lines"), F.sum("stems").alias("stems"))


@query("split_by_state", with_orders("select case state_canonical when 'confirmado' then 'confirmed' when 'pendiente' then 'pending' when 'en_proceso' then 'estimates' when 'otro' then 'other' else 'changes' end as part, count(*) as lines, sum(stems) as stems from clean group by all"))
def split_by_state(spark, sf_dir):
    parts = cleaning.split_by_state(orders(spark, sf_dir))
    out = None
    for name, part in parts.items():
        if name != "all":
            one = part.groupBy(F.lit(name).alias("part")).agg(F.count(F.lit(1)).alias("lines"), F.sum("stems").alias("stems"))
            out = one if out is None else out.unionByName(one)
    return out


@query("type_reference", with_orders("""
, known as (select client_code, box_key, min(order_type) as reference_type from hist where order_type <> 'OTRO_NO_CLASIFICADO' group by all having count(distinct order_type) = 1),
stable as (select client_code, box_key, product, variety, color, min(order_type) as reference_type from hist where order_type <> 'OTRO_NO_CLASIFICADO' group by all having count(distinct order_type) = 1),
exact as (select order_date, client_code, order_id, box_key, product, variety, color, grade, box_type, min(order_type) as reference_type from hist where order_type <> 'OTRO_NO_CLASIFICADO' group by all having count(distinct order_type) = 1)
select c.order_type, coalesce(e.reference_type, s.reference_type, k.reference_type) as reference_type, count(*) as lines
from clean c left join exact e using (order_date, client_code, order_id, box_key, product, variety, color, grade, box_type)
left join stable s using (client_code, box_key, product, variety, color) left join known k using (client_code, box_key) group by all""".replace("\n, known", ", known", 1)).replace("stems > 0)\n, known", "stems > 0), known"))
def type_reference(spark, sf_dir):
    lines = orders(spark, sf_dir)
    reference = cleaning.build_type_reference(history(spark, sf_dir))
    return cleaning.attach_type_reference(lines, reference).groupBy("order_type", "reference_type").agg(F.count(F.lit(1)).alias("lines"))


WEEKLY_SQL = """, weekly as (
  select client_code, client, year_week, sum(stems) as week_stems, sum(stems_confirmed) as week_confirmed, sum(shortfall) as week_shortfall,
    count(distinct product) as products, count(distinct color) as colors, count(distinct variety) as varieties,
    count(distinct sku_finished) as skus_finished, count(distinct sku_flexible) as skus_flexible,
    count(distinct order_type) as order_types, count(distinct order_date) as dates
  from hist group by all)
"""


@query("client_weekly_base", with_orders(WEEKLY_SQL + "select * from weekly"))
def client_weekly_base(spark, sf_dir):
    return profile.client_weekly_base(history(spark, sf_dir))


VOLUME_SQL = WEEKLY_SQL + """, volumes as (
  select client_code, client, count(*) as active_weeks, sum(week_stems) as stems, avg(week_stems) as mean_week, quantile_cont(week_stems, 0.5) as median_week,
    stddev_samp(week_stems) as std_week, min(week_stems) as min_week, max(week_stems) as max_week, avg(products) as mean_products,
    avg(colors) as mean_colors, avg(varieties) as mean_varieties, avg(skus_finished) as mean_skus_finished, avg(skus_flexible) as mean_skus_flexible,
    avg(order_types) as mean_order_types, sum(week_confirmed) as confirmed, sum(week_shortfall) as shortfall,
    (select count(distinct year_week) from hist) as weeks_observed
  from weekly group by all),
volume_stats as (select *, active_weeks / weeks_observed as active_share, coalesce(coalesce(std_week, 0) / nullif(mean_week, 0), 0) as cv,
  least(greatest(coalesce(confirmed / nullif(stems, 0), 0), 0), 1) as fulfilment from volumes)
"""


@query("client_volume_stats", with_orders(VOLUME_SQL + "select * from volume_stats"))
def client_volume_stats(spark, sf_dir):
    return profile.client_volume_stats(history(spark, sf_dir))


RECENCY_SQL = ", recency as (select client_code, client, min(order_date) as first_date, max(order_date) as last_date, cast(max(m) - max(order_date) as integer) as days_since, " + ", ".join(
    f"count(distinct case when order_date >= m - {7 * w} then year_week end) as active_weeks_{w}w, sum(case when order_date >= m - {7 * w} then stems else 0 end) as stems_{w}w" for w in profile.WINDOWS
) + ", max(m) - max(order_date) <= 112 as active_16w from (select *, max(order_date) over () as m from hist) group by all)\n"


@query("client_recency", with_orders(RECENCY_SQL + "select * from recency"))
def client_recency(spark, sf_dir):
    return profile.client_recency(history(spark, sf_dir))


def _top_sql(column: str, n: int, name: str) -> str:
    return f""", {name} as (select client_code, client, coalesce(sum(s) filter (where p <= {n}) / nullif(sum(s), 0), 0) as {name}
  from (select client_code, client, s, row_number() over (partition by client_code, client order by s desc, {column}) as p
    from (select client_code, client, {column}, sum(stems) as s from hist group by all)) group by all)"""


TOP_SQL = "".join(_top_sql(*t) for t in profile.TOP_SHARES)
TOP_ALL = ", tops as (select * from " + " join ".join(t[2] + (" using (client_code, client)" if k else "") for k, t in enumerate(profile.TOP_SHARES)) + ")\n"


@query("client_top_share", with_orders(TOP_SQL + TOP_ALL + "select * from tops"))
def client_top_share(spark, sf_dir):
    return profile.client_top_share(history(spark, sf_dir))


def _entropy_sql(column: str) -> str:
    return f""", e_{column} as (select client_code, client, case when count(*) > 1 then -sum(p * ln(p)) / ln(count(*)) else 0 end as entropy_{column}
  from (select client_code, client, s / sum(s) over (partition by client_code, client) as p from (select client_code, client, {column}, sum(stems) as s from hist group by all)) where p > 0 group by all)"""


ENTROPY_SQL = "".join(map(_entropy_sql, profile.ENTROPIES))
ENTROPY_ALL = ", entropies as (select * from " + " join ".join(f"e_{c}" + (" using (client_code, client)" if k else "") for k, c in enumerate(profile.ENTROPIES)) + ")\n"


@query("client_entropy", with_orders(ENTROPY_SQL + ENTROPY_ALL + "select * from entropies"))
def client_entropy(spark, sf_dir):
    return profile.client_entropy(history(spark, sf_dir))


def _similar_sql(c: str) -> str:
    return f""", w_{c} as (select client_code, client, year_week, {c} as item, sum(stems) as s, dense_rank() over (partition by client_code, client order by year_week) as r from hist group by client_code, client, year_week, {c}),
n_{c} as (select client_code, client, r, sqrt(sum(s * s)) as norm from w_{c} group by all),
d_{c} as (select a.client_code, a.client, a.r, sum(a.s * b.s) as dot from w_{c} a join w_{c} b on a.client_code = b.client_code and a.client = b.client and a.item = b.item and a.r = b.r + 1 group by all),
c_{c} as (select n.client_code, n.client, n.r, coalesce(d.dot, 0) / (n.norm * p.norm) as cosine from n_{c} n join n_{c} p on n.client_code = p.client_code and n.client = p.client and n.r = p.r + 1 left join d_{c} d on n.client_code = d.client_code and n.client = d.client and n.r = d.r),
s_{c} as (select n.client_code, n.client, coalesce(avg(cosine), 0) as similarity_{c}, coalesce(min(cosine), 0) as similarity_min_{c} from n_{c} n left join c_{c} c using (client_code, client, r) group by all)"""


SIMILAR_SQL = "".join(map(_similar_sql, profile.SIMILARITIES))
SIMILAR_ALL = ", likeness as (select * from " + " join ".join(f"s_{c}" + (" using (client_code, client)" if k else "") for k, c in enumerate(profile.SIMILARITIES)) + ")\n"


@query("weekly_mix_similarity", with_orders(SIMILAR_SQL + SIMILAR_ALL + "select * from likeness"))
def weekly_mix_similarity(spark, sf_dir):
    return profile.weekly_mix_similarity(history(spark, sf_dir))


SHARES_SQL = ", type_shares as (select *, least(share_solido + share_surtido + share_surtido_m, 1) as share_easy, least(share_surtido + share_surtido_m + share_rainbow + share_bouquet + share_bqt + share_combo, 1) as share_mixed from (select client_code, client, " + ", ".join(
    f"coalesce(sum(case when order_type = '{t}' then stems else 0 end) / nullif(sum(stems), 0), 0) as share_{t.lower()}" for t in profile.SHARE_TYPES
) + " from hist group by all))\n"


@query("client_type_shares", with_orders(SHARES_SQL + "select * from type_shares"))
def client_type_shares(spark, sf_dir):
    return profile.client_type_shares(history(spark, sf_dir))


def _minmax_sql(c: str) -> str:
    x = f"coalesce({c}, 0)"
    return f"100 - case when min({x}) over () = max({x}) over () then case when max({x}) over () > 0 then 100 else 0 end else ({x} - min({x}) over ()) / nullif(max({x}) over () - min({x}) over (), 0) * 100 end as m_{c}"


PROFILE_SQL = VOLUME_SQL + RECENCY_SQL + TOP_SQL + TOP_ALL + ENTROPY_SQL + ENTROPY_ALL + SIMILAR_SQL + SIMILAR_ALL + SHARES_SQL + f""", based as (
  select *, least(cv, 2) as cv_cut from volume_stats join recency using (client_code, client) join tops using (client_code, client)
  join entropies using (client_code, client) join likeness using (client_code, client) join type_shares using (client_code, client)),
ended as (select *, {", ".join(_minmax_sql(c) for c in ("cv_cut", "entropy_color", "entropy_sku_finished", "entropy_analysis_key", "entropy_pack_key", "entropy_order_type"))} from based),
parts as (select *, least(greatest(active_share * 100, 0), 100) as score_frequency, m_cv_cut as score_volume,
  least(greatest(45 * top3_color + 35 * similarity_color + 0.2 * m_entropy_color, 0), 100) as score_color,
  least(greatest(55 * top5_sku_finished + 30 * similarity_sku_finished + 0.15 * m_entropy_sku_finished, 0), 100) as score_sku,
  least(greatest(50 * top5_analysis + 35 * similarity_analysis_key + 0.15 * m_entropy_analysis_key, 0), 100) as score_analysis,
  least(greatest(70 * top3_pack + 0.3 * m_entropy_pack_key, 0), 100) as score_pack,
  least(greatest(55 * top1_order_type + 30 * similarity_order_type + 0.15 * m_entropy_order_type, 0), 100) as score_type,
  least(greatest((1 - fulfilment) * 100, 0), 100) as score_miss, least(greatest(share_easy * 100 - share_rainbow * 40, 0), 100) as score_ease from ended),
summed as (select *, cast(round((0.14 * score_frequency + 0.14 * score_volume + 0.23 * score_color + 0.18 * score_analysis + 0.08 * score_pack + 0.08 * score_type + 0.15 * score_miss) * 1e8) as bigint) as x from parts),
rated as (select * exclude (x), (x // 1000000 + case when x % 1000000 > 500000 or (x % 1000000 = 500000 and (x // 1000000) % 2 = 1) then 1 else 0 end) / 100.0 as score_purchase from summed),
mixed as (select *, cast(round((0.82 * score_purchase + 0.18 * score_ease) * 1e8) as bigint) as y from rated),
profiles as (select * exclude (y), (y // 1000000 + case when y % 1000000 > 500000 or (y % 1000000 = 500000 and (y // 1000000) % 2 = 1) then 1 else 0 end) / 100.0 as score_operative,
  case when score_purchase >= 80 then 'ALTA_PRIORIDAD_COMPRAR_TERMINADO' when score_purchase between 65 and 79.999 then 'PILOTO_SKUS_TOP' when score_purchase between 50 and 64.999 then 'COMPRAR_COLOR_O_BASE_VALIDAR' else 'NO_ANTICIPAR_TERMINADO' end as recommendation,
  case when score_frequency >= 70 and score_color >= 70 and score_sku >= 65 then 'CONSTANTE_ESTRUCTURA_ESTABLE' when score_frequency >= 70 and score_color < 70 then 'CONSTANTE_PERO_VARIABLE_COLOR_SKU' when score_frequency < 40 then 'OCASIONAL' else 'INTERMEDIO' end as client_segment from mixed)
"""
PROFILE_COLUMNS = [
    "client_code", "client", "active_weeks", "stems", "cv", "days_since", "active_16w", "score_frequency", "score_volume", "score_color",
    "score_sku", "score_analysis", "score_pack", "score_type", "score_miss", "score_ease", "score_purchase", "score_operative",
    "recommendation", "client_segment",
]


@query("client_profile", with_orders(PROFILE_SQL + f"select {', '.join(PROFILE_COLUMNS)} from profiles"))
def client_profile(spark, sf_dir):
    return profile.client_profile(history(spark, sf_dir)).select(*PROFILE_COLUMNS)


@query("filter_profiles", with_orders(PROFILE_SQL + "select client_code, client, score_purchase, client_segment from profiles where score_purchase >= 40 and active_16w"))
def filter_profiles(spark, sf_dir):
    kept = profile.filter_profiles(profile.client_profile(history(spark, sf_dir)), least_score=40, active_only=True)
    return kept.select("client_code", "client", "score_purchase", "client_segment")


@query("segment_overview", with_orders(PROFILE_SQL + "select client_segment, count(*) as clients, sum(stems) as stems, avg(score_purchase) as mean_score from profiles group by all"))
def segment_overview(spark, sf_dir):
    return profile.segment_overview(profile.client_profile(history(spark, sf_dir)))


def _mix_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""select *, sum(stems) over (partition by client_code, client) as client_stems, coalesce(stems / nullif(sum(stems) over (partition by client_code, client), 0), 0) as client_share,
  least(greatest(coalesce(confirmed / nullif(stems, 0), 0), 0), 1) as fulfilment
from (select client_code, client, {k}, sum(stems) as stems, sum(stems_confirmed) as confirmed, sum(shortfall) as shortfall,
  count(distinct year_week) as active_weeks, count(distinct order_date) as active_dates from hist group by all)"""


for _name, _keys in mix.MIXES.items():
    query(_name, with_orders(_mix_sql(_keys)))(lambda spark, sf_dir, keys=_keys: mix.mix(history(spark, sf_dir), keys))


def _sales_sql(keys: list[str]) -> str:
    return f"""select *, coalesce(sales_usd / nullif(confirmed, 0), 0) as price_usd, coalesce(total_value / nullif(confirmed, 0), 0) as price_original
from (select {', '.join(keys)}, sum(stems_confirmed) as confirmed, sum(sales_usd) as sales_usd, sum(total_value) as total_value,
  count(distinct order_id) as orders, count(distinct box_key) as boxes from clean where state_canonical = 'confirmado' group by all)"""


def confirmed(spark, sf_dir):
    return orders(spark, sf_dir).where("state_canonical = 'confirmado'")


for _name, _keys in mix.SALES.items():
    query(_name, with_orders(_sales_sql(_keys)))(lambda spark, sf_dir, keys=_keys: mix.sales(confirmed(spark, sf_dir), keys))


@query("series_client_week", with_orders("select client_code, client, year_week, iso_year, iso_week, sum(stems) as stems, sum(stems_confirmed) as confirmed, sum(shortfall) as shortfall, count(distinct color) as colors, count(distinct sku_finished) as skus_finished, count(distinct product) as products, count(distinct order_type) as order_types from hist group by all"))
def series_client_week(spark, sf_dir):
    return mix.series_client_week(history(spark, sf_dir))


@query("series_client_month_color", with_orders("select client_code, client, iso_year, month, color, sum(stems) as stems, sum(shortfall) as shortfall from hist group by all"))
def series_client_month_color(spark, sf_dir):
    return mix.series_client_month_color(history(spark, sf_dir))


DEMAND = ", ".join(mix.DEMAND_KEYS)


@query("operational_demand_summary", with_orders(f"select {DEMAND}, sum(stems) as stems, count(distinct order_id) as orders, case state_canonical when 'pendiente' then 'pending' when 'en_proceso' then 'estimate' else 'change' end as source from clean where state_canonical in ('pendiente', 'en_proceso', 'por_verificar', 'reproceso') group by {DEMAND}, source"))
def operational_demand_summary(spark, sf_dir):
    state = F.col("state_canonical")
    source = F.when(state == "pendiente", "pending").when(state == "en_proceso", "estimate").otherwise("change")
    lines = orders(spark, sf_dir).where(state.isin("pendiente", "en_proceso", "por_verificar", "reproceso"))
    return mix.operational_demand_summary(lines, source)


ROLLUP = """select *, coalesce(sales_usd / nullif(stems, 0), 0) as price_usd, least(greatest(coalesce(confirmed / nullif(stems, 0), 0), 0), 1) as fulfilment
from (select {keys}, sum(stems) as stems, sum(stems_confirmed) as confirmed, sum(sales_usd) as sales_usd, count(distinct order_id) as orders, count(distinct box_key) as boxes, count(distinct year_week) as weeks from hist group by all)"""
for _name, _keys in {"operational_rollup": ["product", "color"], "order_type_mix": ["order_type"], "overview_product": ["product"], "overview_color": ["color"], "overview_sku": ["sku_operational"], "overview_week": ["iso_year", "iso_week"], "overview_client": ["client_code", "client"], "annual_kpis": ["iso_year"]}.items():
    query(_name, with_orders(ROLLUP.format(keys=", ".join(_keys))))(lambda spark, sf_dir, keys=_keys: mix.operational_rollup(history(spark, sf_dir), keys))


def _labels_sql(column: str, n: int) -> str:
    return f"""select client_code, client, iso_year, iso_week, sku_operational, string_agg({column}, ', ' order by place) as top_{column}s from (
  select *, row_number() over (partition by client_code, client, iso_year, iso_week, sku_operational order by n desc, {column}) as place
  from (select client_code, client, iso_year, iso_week, sku_operational, {column}, count(*) as n from hist where {column} <> 'sin_info' group by all)) where place <= {n} group by all"""


@query("client_week_sku", with_orders(f""", r as ({ROLLUP.format(keys='client_code, client, iso_year, iso_week, sku_operational')}), p as ({_labels_sql('product', 3)}), c as ({_labels_sql('color', 3)})
select * exclude (price_usd), coalesce(stems / nullif(sum(stems) over (partition by client_code, client, iso_year, iso_week), 0), 0) as week_share
from r left join p using (client_code, client, iso_year, iso_week, sku_operational) left join c using (client_code, client, iso_year, iso_week, sku_operational)"""))
def client_week_sku(spark, sf_dir):
    return mix.client_week_sku(history(spark, sf_dir))


@query("top_label_join", with_orders("select client_code, string_agg(color, ', ' order by place) as colors from (select *, row_number() over (partition by client_code order by n desc, color) as place from (select client_code, color, count(*) as n from hist group by all)) where place <= 3 group by all"))
def top_label_join(spark, sf_dir):
    return mix.top_labels(history(spark, sf_dir), ["client_code"], "color", 3, "colors")


@query("distinct_label_join", with_orders("select client_code, string_agg(variety, ', ' order by variety) as varieties from (select *, row_number() over (partition by client_code order by variety) as place from (select distinct client_code, variety from hist)) where place <= 5 group by all"))
def distinct_label_join(spark, sf_dir):
    return mix.distinct_labels(history(spark, sf_dir), ["client_code"], "variety", 5, "varieties")
