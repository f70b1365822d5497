"""Queries of the whole client dataset and of the readings of clusters; constants of the SQL are typed out here on purpose."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.operators import client_dataset as ds
from bloomline.operators import cluster_reports as ops
from bloomline.operators import clustering
from bloomline.operators import profile
from bloomline.plans import order_queries as oq
from bloomline.plans.fixtures import history, market_sql, with_orders
from bloomline.plans.registry import query
from bloomline.sources.tables import stored, stored_once

ON = "using (client_code, client)"
SQL_DIMENSIONS = {"color": "color", "product": "product", "type": "order_type", "sku": "sku_operational", "pack": "pack_key", "box": "box_type"}
SQL_TOP = {"color": 20, "product": 15, "type": 8, "pack": 10, "sku": 20}
SHARES = [(d, i) for d, n in SQL_TOP.items() for i in range(1, n + 1)]


def _dimension_sql(d: str, column: str) -> str:
    out = f""", g_{d} as (select client_code, client, {column} as value, sum(stems) as s from hist group by all),
r_{d} as (select *, s / sum(s) over (partition by client_code, client) as p, row_number() over (partition by client_code, client order by s desc, value) as place from g_{d}),
v_{d} as (select client_code, client, count(*) as distinct_{d}, -sum(case when p > 0 then p * ln(p) else 0 end) as entropy_{d},
  case when count(*) filter (where p > 0) > 1 then -sum(case when p > 0 then p * ln(p) else 0 end) / ln(count(*) filter (where p > 0)) else 0 end as entropy_norm_{d},
  {", ".join(f"sum(case when place <= {n} then p else 0 end) as top{n}_{d}" for n in (1, 3, 5))}, max(case when place = 1 then value end) as dominant_{d} from r_{d} group by all)"""
    if d in SQL_TOP:
        out += f""", t_{d} as (select value, row_number() over (order by sum(s) desc, value) as i from g_{d} group by value),
m_{d} as (select client_code, client, {", ".join(f"sum(case when i = {i} then s else 0 end) / sum(s) as share_{d}_{i}" for i in range(1, SQL_TOP[d] + 1))} from g_{d} join t_{d} using (value) where i <= {SQL_TOP[d]} group by all)"""
    return out


KEPT = ["main_country", "market", "stems", "stems_confirmed", "shortfall", "sales_usd", "recent_stems", "previous_stems", "recent_change", "orders", "boxes", "stems_per_bunch_mean", "bunches_per_box_mean",
        "fulfilment", "usd_per_stem", "volume_log", "active_weeks", "mean_week", "median_week", "cv", "stability", "top1_color", "top3_color", "top1_product", "top3_product", "top1_type", "top1_sku", "top5_sku",
        *[f"{x}_{d}" for d in ("color", "product", "type", "sku") for x in ("distinct", "entropy", "entropy_norm")], "dominant_product", "dominant_color", "dominant_type", "dominant_box",
        "complexity", "complexity_band", "market_share"]
PROFILE_KEPT = ["active_share", "score_purchase", "score_operative", "score_frequency", "score_volume", "score_color", "score_sku", "score_pack", "score_type", "recommendation", "client_segment"]
DATASET = (
    oq.PROFILE_SQL
    + "".join(_dimension_sql(d, c) for d, c in SQL_DIMENSIONS.items())
    + f""", aged as (select *, date_diff('day', order_date, max(order_date) over ()) as ago from hist),
figures as (select client_code, client, mode(country order by country) as main_country, sum(stems) as stems, sum(stems_confirmed) as stems_confirmed, sum(shortfall) as shortfall, sum(sales_usd) as sales_usd,
  sum(case when ago <= 55 then stems else 0 end) as recent_stems, sum(case when ago between 56 and 111 then stems else 0 end) as previous_stems, count(distinct order_id) as orders, count(distinct box_id) as boxes,
  sum(bunch_size * stems) / sum(stems) as stems_per_bunch_mean, sum(bunches_per_box * stems) / sum(stems) as bunches_per_box_mean from aged group by all),
weeks as (select client_code, client, count(*) as active_weeks, avg(week_stems) as mean_week, quantile_cont(week_stems, 0.5) as median_week, stddev_pop(week_stems) / avg(week_stems) as cv from weekly group by all),
together as (select f.*, {market_sql("main_country")} as market, stems_confirmed / stems as fulfilment, sales_usd / stems as usd_per_stem, ln(1 + stems) as volume_log,
  case when previous_stems > 0 then recent_stems / previous_stems - 1 else 0 end as recent_change, w.* exclude (client_code, client), 1 / (1 + cv) as stability,
  {", ".join(f"v_{d}.* exclude (client_code, client)" for d in SQL_DIMENSIONS)},
  {", ".join(f"coalesce(share_{d}_{i}, 0) as share_{d}_{i}" for d, i in SHARES)}
  from figures f join weeks w {ON} {" ".join(f"join v_{d} {ON}" for d in SQL_DIMENSIONS)} {" ".join(f"left join m_{d} {ON}" for d in SQL_TOP)}),
complex as (select *, 100 * (0.35 * entropy_norm_type + 0.25 * entropy_norm_product + 0.25 * entropy_norm_sku + 0.15 * (1 - top1_type)) as complexity from together),
dataset as (select x.*, case when round(complexity, 9) <= 30 then 'BAJA' when round(complexity, 9) <= 60 then 'MEDIA' else 'ALTA' end as complexity_band, stems / sum(stems) over (partition by market) as market_share,
  {", ".join(f"p.{c}" for c in PROFILE_KEPT)} from complex x join (select client_code, client, {", ".join(PROFILE_KEPT)} from profiles) p {ON})
"""
)
#: Fixed assignments, so that what follows the fit can be compared.
CLUSTERS = """, clusters as (select *, market || '_C0' || (cast(client_code as bigint) % 3 + 1) as cluster_id, 'GRUPO_' || (cast(client_code as bigint) % 3) as cluster_name,
  case when cast(client_code as bigint) % 2 = 0 then 'kmeans' else 'kmodes' end as cluster_method from dataset)
"""


def dataset(spark, sf_dir):
    lines = stored_once(history(spark, sf_dir), ds.DATASET_USED | profile.PROFILE_USED, "report-lines")
    return ds.client_dataset(lines, profile.client_profile(lines))


def clusters(spark, sf_dir):
    code = F.col("client_code").cast("bigint")
    named = {
        "cluster_id": F.concat("market", F.lit("_C0"), (code % 3 + 1).cast("string")), "cluster_name": F.concat(F.lit("GRUPO_"), (code % 3).cast("string")),
        "cluster_method": F.when(code % 2 == 0, "kmeans").otherwise("kmodes"),
    }
    return stored(dataset(spark, sf_dir).withColumns(named), "report-clusters")


@query("client_dataset", with_orders(DATASET + f"select client_code, client, {', '.join(KEPT + PROFILE_KEPT)} from dataset"))
def client_dataset(spark, sf_dir):
    """The whole list of features of cluster_features."""
    return dataset(spark, sf_dir).select("client_code", "client", *KEPT, *PROFILE_KEPT)


@query("client_dataset_shares", with_orders(DATASET + f"select client_code, client, {', '.join(f'share_{d}_{i}' for d, i in SHARES)} from dataset"))
def client_dataset_shares(spark, sf_dir):
    """The five share matrices of cluster_features."""
    lines = history(spark, sf_dir)
    sums = stored(ds.value_sums(lines), "dataset-sums")
    clients = sums.select("client_code", "client").distinct()
    return clients.join(ds.share_columns(sums, ds.leading_values(sums)), ["client_code", "client"], "left").na.fill(0.0)


# Weight, block and label of the features, typed out.
LABELS = {
    "active_share": (1.6, "constancia", "constancia: % semanas activas"), "active_weeks": (1.6, "constancia", "constancia: semanas activas"),
    "stability": (1.6, "constancia", "constancia: estabilidad de volumen"), "cv": (1.6, "constancia", "constancia: variabilidad semanal"),
    "volume_log": (0.8, "volumen", "volumen: escala total"), "mean_week": (0.8, "volumen", "volumen: tallos promedio semana"), "fulfilment": (0.5, "cumplimiento", "cumplimiento"),
    "top1_color": (2.4, "color", "color: concentracion color principal"), "top3_color": (2.4, "color", "color: concentracion top 3"),
    "entropy_norm_color": (2.4, "color", "color: diversidad"), "distinct_color": (2.4, "color", "color: cantidad de colores"),
    "top1_product": (2.0, "producto", "producto: concentracion producto principal"), "top3_product": (2.0, "producto", "producto: concentracion top 3"),
    "entropy_norm_product": (2.0, "producto", "producto: diversidad"), "distinct_product": (2.0, "producto", "producto: cantidad de productos"),
    "top1_type": (1.7, "tipo_pedido", "tipo pedido: concentracion formato principal"), "entropy_norm_type": (1.7, "tipo_pedido", "tipo pedido: diversidad"),
    "distinct_type": (1.7, "tipo_pedido", "tipo pedido: cantidad de formatos"), "top1_sku": (0.8, "sku", "SKU: concentracion SKU principal"),
    "top5_sku": (0.8, "sku", "SKU: repeticion top 5"), "entropy_norm_sku": (0.8, "sku", "SKU: diversidad"),
    "stems_per_bunch_mean": (1.0, "operativo", "operativo: tallos por ramo"), "bunches_per_box_mean": (1.0, "operativo", "operativo: ramos por caja"),
    **{f"share_color_{i}": (2.4, "color", f"color mix: {i}") for i in range(1, 21)}, **{f"share_product_{i}": (2.0, "producto", f"producto mix: {i}") for i in range(1, 16)},
    **{f"share_type_{i}": (1.7, "tipo_pedido", f"tipo pedido mix: {i}") for i in range(1, 9)},
}
DIFFERENCES = f""", long as (unpivot (select market, cluster_id, cluster_name, {", ".join(f"cast({c} as double) as {c}" for c in LABELS)} from clusters) on {", ".join(LABELS)} into name feature value v),
market_figures as (select market, feature, avg(v) as market_mean, stddev_pop(v) as sd from long group by all), own as (select market, cluster_id, cluster_name, feature, avg(v) as cluster_mean from long group by all),
labels(feature, block_weight, block, feature_label) as (values {", ".join(f"('{c}', cast({w} as double), '{b}', '{label}')" for c, (w, b, label) in LABELS.items())}),
set_apart as (select *, case when abs(cluster_mean - market_mean) <= 1e-9 * greatest(abs(market_mean), 1e-3) then 0 else cluster_mean - market_mean end as delta from own join market_figures using (market, feature) join labels using (feature)),
weighed as (select *, delta / case when sd > 1e-12 then sd else 1 end as z_delta, case when delta > 0 then 'mas alto que su mercado' else 'mas bajo que su mercado' end as reading from set_apart),
placed as (select *, abs(z_delta) * sqrt(block_weight) as importance, row_number() over (partition by market, cluster_id, cluster_name order by round(abs(z_delta) * sqrt(block_weight), 7) desc, feature) as place from weighed)
"""


@query("feature_differences", with_orders(DATASET + CLUSTERS + DIFFERENCES + "select market, cluster_id, cluster_name, block, feature, feature_label, cluster_mean, market_mean, block_weight, delta, z_delta, importance, reading, place from placed where place <= 10"))
def feature_differences(spark, sf_dir):
    rows = clusters(spark, sf_dir)
    return ds.feature_differences(rows, rows)


@query("cluster_variable_reading", with_orders(DATASET + CLUSTERS + DIFFERENCES + """select market, cluster_id, place, feature_label as variable, importance,
  coalesce(case feature when 'top1_color' then 'Peso del color principal en la compra.' when 'top3_color' then 'Concentracion del volumen en los tres colores principales.'
    when 'entropy_norm_color' then 'Diversidad de colores comprados.' when 'top1_product' then 'Dependencia del producto principal.' when 'top3_product' then 'Concentracion en el portafolio principal.'
    when 'entropy_norm_product' then 'Diversidad de productos comprados.' when 'top1_type' then 'Concentracion en un formato de pedido.' when 'active_share' then 'Frecuencia con que el cliente compra en el ano.'
    when 'cv' then 'Variabilidad del volumen semanal.' end, feature_label) as meaning,
  case block when 'color' then 'Ayuda a definir ofertas y disponibilidad por color.' when 'producto' then 'Orienta el portafolio que conviene ofrecer al grupo.'
    when 'tipo_pedido' then 'Indica si la propuesta debe plantearse por formato operativo.' when 'constancia' then 'Distingue programas recurrentes de compras de oportunidad.'
    when 'volumen' then 'Permite priorizar cuentas por impacto comercial.' when 'sku' then 'Identifica repeticion de configuraciones comerciales.'
    else 'Describe una diferencia relevante frente al mercado.' end || ' Resultado: ' || reading || '.' as business_reading
from placed where place <= 3"""))
def cluster_variable_reading(spark, sf_dir):
    rows = clusters(spark, sf_dir)
    return ops.cluster_variable_reading(ds.feature_differences(rows, rows))


def _base_sql(column: str) -> str:
    return f""", b_{column} as (select cluster_id, string_agg(value, ', ' order by p) as base_{column} from (select cluster_id, value, row_number() over (partition by cluster_id order by s desc, value) as p
  from (select cluster_id, dominant_{column} as value, sum(stems) as s from clusters group by all)) where p <= 2 group by all)"""


@query("cluster_commercial_actions", with_orders(DATASET + CLUSTERS + DIFFERENCES + "".join(map(_base_sql, ("product", "color", "type"))) + """,
best as (select cluster_id, block from placed where place = 1),
means as (select market, cluster_id, cluster_name, count(distinct client_code) as clients, sum(stems) as stems, sum(sales_usd) as sales_usd, round(avg(cv), 9) as a_cv, round(avg(top3_color), 9) as a_color,
  round(avg(top1_type), 9) as a_type, round(avg(score_purchase), 9) as a_score, round(avg(complexity), 9) as a_complexity, round(avg(recent_change), 9) as a_recent from clusters group by all),
worded as (select *, case when a_cv <= 0.55 then 'constantes' when a_cv <= 1 then 'intermedios' else 'variables' end as rhythm,
  case when a_color >= 0.75 then 'muy concentrados en color' when a_color >= 0.5 then 'color moderadamente concentrado' else 'mix de color amplio' end as colors,
  case when a_type >= 0.85 then 'formato operativo repetitivo' when a_type >= 0.6 then 'formato dominante con variaciones' else 'formatos variados' end as formats from means join best using (cluster_id)),
ruled as (select *, case when rhythm = 'constantes' and a_color >= 0.5 and a_type >= 0.85 then 1 when block = 'producto' then 2 when block = 'color' then 3 when block = 'tipo_pedido' then 4 when rhythm = 'variables' then 5 else 6 end as rule from worded)
select market, cluster_id, cluster_name, clients, stems, sales_usd, rhythm || ', ' || colors || ', ' || formats as commercial_profile, base_product, base_color, base_type, block,
  ['programas recurrentes, preventa y ofertas cerradas por color/producto/formato', 'venta cruzada alrededor del producto dominante', 'campanas por color y manejo de sustitutos', 'ofertas por formato operativo',
   'venta oportunistica y validacion comercial previa', 'seguimiento comercial por comportamiento parecido'][rule] as opportunity,
  ['proponer portafolio fijo, calendario comercial y sustitutos controlados', 'ofrecer extensiones de producto, colores cercanos y paquetes por familia',
   'segmentar ofertas por color dominante y disponibilidad de colores equivalentes', 'vender estructuras similares segun SOLIDO/SURTIDO/BOUQUET/BQT/COMBO/RAINBOW/BULK y no solo por variedad',
   'usar como lista de prospeccion/seguimiento, evitando comprometer compra anticipada sin confirmacion', 'comparar clientes espejo y replicar ofertas probadas en el mismo cluster'][rule] as commercial_action,
  case when rhythm = 'variables' then 'alta variabilidad; validar pedido antes de anticipar compra' when a_score < 55 then 'score bajo para compra terminada; usar como lectura comercial antes que compromiso operativo'
    when a_color < 0.5 then 'mix amplio; evitar ofertas demasiado cerradas en un solo color' else 'riesgo operativo moderado; revisar disponibilidad y cumplimiento' end as main_risk,
  case when a_complexity >= 60 then 'preparar estructura, sustitutos y validacion de armado antes de confirmar oferta' when a_type >= 0.85 then 'estandarizar presentacion recurrente y validar disponibilidad del formato dominante'
    else 'revisar composicion antes de comprometer disponibilidad' end as operative_action,
  case when rhythm = 'constantes' then 'incorporar demanda base al plan y revisar excepciones por color o producto' when a_recent > 0.2 then 'monitorear crecimiento reciente y elevar cobertura solo con confirmacion comercial'
    else 'planear bajo escenarios y evitar reservar volumen rigido' end as planning_action
from ruled join b_product using (cluster_id) join b_color using (cluster_id) join b_type using (cluster_id)"""))
def cluster_commercial_actions(spark, sf_dir):
    """The block of a cluster is here that of its most telling feature."""
    rows = clusters(spark, sf_dir)
    best = ds.feature_differences(rows, rows, 1).select("market", "cluster_id", F.col("block").alias("top_block"))
    return ops.cluster_commercial_actions(rows, best)


@query("cluster_benchmark", with_orders(DATASET + CLUSTERS + """, labels(name, indicator) as (values ('stems', 'Volumen por cliente'), ('active_weeks', 'Semanas activas'), ('cv', 'Variabilidad semanal'),
  ('top3_color', 'Concentracion color top 3'), ('top5_sku', 'Concentracion SKU top 5'), ('top1_type', 'Concentracion tipo pedido'), ('sales_usd', 'Ventas USD por cliente'),
  ('recent_change', 'Cambio reciente vs previo'), ('complexity', 'Complejidad operativa')),
long as (unpivot (select market, cluster_id, cluster_name, cast(stems as double) as stems, cast(active_weeks as double) as active_weeks, cv, top3_color, top5_sku, top1_type, cast(sales_usd as double) as sales_usd, recent_change, complexity from clusters)
  on stems, active_weeks, cv, top3_color, top5_sku, top1_type, sales_usd, recent_change, complexity into name name value v),
own as (select market, cluster_id, cluster_name, name, avg(v) as cluster_value from long group by all), all_of as (select market, name, avg(v) as market_value from long group by all),
met as (select *, case when abs(cluster_value - market_value) <= 1e-9 * greatest(abs(market_value), 1e-3) then 0 else cluster_value - market_value end as difference from own join all_of using (market, name) join labels using (name))
select market, cluster_id, cluster_name, indicator, cluster_value, market_value, difference, case when difference > 0 then 'Por encima del mercado' else 'Por debajo del mercado' end as reading from met"""))
def cluster_benchmark(spark, sf_dir):
    return ops.cluster_benchmark(clusters(spark, sf_dir))


@query("cluster_overview", with_orders(DATASET + CLUSTERS + """select market, cluster_id, cluster_name, cluster_method, count(distinct client_code) as clients, sum(stems) as stems, sum(sales_usd) as sales_usd,
  cast(sum(cast(score_purchase as decimal(18, 2))) as double) / count(score_purchase) as mean_score, avg(top3_color) as mean_color, avg(top5_sku) as mean_sku, avg(cv) as mean_cv, avg(fulfilment) as mean_fulfilment, avg(recent_change) as mean_recent_change,
  avg(complexity) as mean_complexity from clusters group by all"""))
def cluster_overview(spark, sf_dir):
    return ops.cluster_overview(clusters(spark, sf_dir))


@query("cluster_type_mix", with_orders(DATASET + CLUSTERS + "select market, cluster_id, cluster_name, dominant_type, count(distinct client_code) as clients, sum(stems) as stems, avg(top1_type) as type_concentration from clusters group by all"))
def cluster_type_mix(spark, sf_dir):
    return ops.cluster_type_mix(clusters(spark, sf_dir))


@query("cluster_method_mix", with_orders(DATASET + CLUSTERS + "select market, cluster_method, count(distinct client_code) as clients, sum(stems) as stems from clusters group by all"))
def cluster_method_mix(spark, sf_dir):
    return ops.cluster_method_mix(clusters(spark, sf_dir))


@query("cluster_dominant_mix", with_orders(DATASET + CLUSTERS + """, long as (select client_code, stems, 'Producto dominante' as dimension, dominant_product as value from clusters union all select client_code, stems, 'Color dominante', dominant_color from clusters
  union all select client_code, stems, 'Tipo pedido dominante', dominant_type from clusters), per as (select dimension, value, count(distinct client_code) as clients, sum(stems) as stems from long group by all)
select * exclude (p) from (select *, row_number() over (partition by dimension order by clients desc, stems desc, value) as p from per) where p <= 10"""))
def cluster_dominant_mix(spark, sf_dir):
    return ops.cluster_dominant_mix(clusters(spark, sf_dir))


@query("cluster_figures", with_orders(DATASET + CLUSTERS + """select market, cluster_id, cluster_name, count(distinct client_code) as clients, sum(stems) as total_stems, avg(stems) as mean_stems, sum(sales_usd) as total_sales_usd,
  avg(sales_usd) as mean_sales_usd, avg(active_weeks) as mean_active_weeks, avg(cv) as mean_cv, avg(recent_change) as mean_recent_change, avg(top3_color) as mean_top3_color, avg(top5_sku) as mean_top5_sku,
  avg(fulfilment) as mean_fulfilment, avg(complexity) as mean_complexity, cast(sum(cast(score_operative as decimal(18, 2))) as double) / count(score_operative) as mean_score_operative, mode(complexity_band order by complexity_band) as common_complexity_band,
  mode(dominant_product order by dominant_product) as common_dominant_product, mode(dominant_color order by dominant_color) as common_dominant_color, mode(dominant_type order by dominant_type) as common_dominant_type
from clusters group by all"""))
def cluster_figures(spark, sf_dir):
    return ops.cluster_figures(clusters(spark, sf_dir))


@query("cluster_representatives_fixed", with_orders(DATASET + CLUSTERS + """select cluster_id, client_code, client, stems, place from (select *, row_number() over (partition by cluster_id order by stems desc, client_code, client) as place from clusters) where place <= 5"""))
def cluster_representatives_fixed(spark, sf_dir):
    """cluster_representatives of clusters that SQL can follow."""
    rows = clusters(spark, sf_dir)
    return clustering.cluster_representatives(rows.drop("cluster_id"), rows)
