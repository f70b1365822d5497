"""Queries of inventory and purchase."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.operators import inventory as ops
from bloomline.plans.fixtures import inventory, orders, with_both, with_inventory
from bloomline.plans.registry import query

ITEM, COLOR = "product, variety, color, grade", "product, color, grade"
BALANCES = "greatest(-balance, 0) as short, greatest(balance, 0) as spare"


def _status(suffix: str = "") -> str:
    return f"case when balance < 0 then 'FALTANTE{suffix}' when balance > 0 then 'SOBRANTE{suffix}' else 'NEUTRO{suffix}' end as status"


@query("inventory_item_day", with_inventory(f"select *, {BALANCES}, {_status()} from (select inv_date, year_week, {ITEM}, sum(balance) as balance, count(distinct farm) as farms from inv group by all)"))
def inventory_item_day(spark, sf_dir):
    return ops.inventory_item_day(inventory(spark, sf_dir))


@query("inventory_farm_day", with_inventory(f"select *, {_status()} from (select inv_date, {ITEM}, farm, sum(balance) as balance from inv group by all)"))
def inventory_farm_day(spark, sf_dir):
    return ops.inventory_farm_day(inventory(spark, sf_dir))


@query("inventory_item_week", with_inventory(f"select *, {BALANCES} from (select year_week, {ITEM}, sum(balance) as balance from inv group by all)"))
def inventory_item_week(spark, sf_dir):
    return ops.inventory_item_week(inventory(spark, sf_dir))


@query("inventory_color_day", with_inventory(f"select *, {BALANCES}, {_status('_COLOR')} from (select inv_date, year_week, {COLOR}, sum(balance) as balance, count(distinct variety) as varieties, count(distinct farm) as farms from inv group by all)"))
def inventory_color_day(spark, sf_dir):
    return ops.inventory_color_day(inventory(spark, sf_dir))


def demand(spark, sf_dir):
    """Pending orders and commercial estimates by day and item; the score is derived from the client's code."""
    lines = orders(spark, sf_dir).where("state_canonical in ('pendiente', 'en_proceso')")
    source = F.when(F.col("state_canonical") == "pendiente", "PENDIENTE_REAL_CLIENTE").otherwise("ESTIMADO_COMERCIAL")
    keys = [F.col("order_date").alias("demand_date"), "iso_year", "iso_week", "year_week", "client_code", "client", "country", "order_id", "order_type", "product", "variety", "color", "grade", source.alias("source")]
    per = lines.groupBy(*keys).agg(F.sum("stems").alias("stems"))
    return per.withColumn("score", (F.col("client_code").cast("bigint") % 100).cast("double"))


DEMAND_SQL = """, demand as (
  select order_date as demand_date, iso_year, iso_week, year_week, client_code, client, country, order_id, order_type, product, variety, color, grade,
    case state_canonical when 'pendiente' then 'PENDIENTE_REAL_CLIENTE' else 'ESTIMADO_COMERCIAL' end as source, sum(stems) as stems,
    cast(cast(client_code as bigint) % 100 as double) as score
  from clean where state_canonical in ('pendiente', 'en_proceso') group by all)
"""
CROSS_SQL = DEMAND_SQL + f""", iv as (select inv_date as demand_date, {ITEM}, sum(balance) as variety_balance, count(distinct farm) as farms from inv group by all),
ic as (select inv_date as demand_date, {COLOR}, sum(balance) as color_balance, count(distinct variety) as varieties from inv group by all),
crossed as (select d.*, coalesce(variety_balance, 0) as variety_balance, coalesce(farms, 0) as farms, coalesce(color_balance, 0) as color_balance, coalesce(varieties, 0) as varieties,
    greatest(-coalesce(color_balance, 0), 0) as color_short, greatest(coalesce(color_balance, 0), 0) as color_spare,
    greatest(-coalesce(variety_balance, 0), 0) as variety_short, greatest(coalesce(variety_balance, 0), 0) as variety_spare,
    case when coalesce(color_balance, 0) < 0 then 'ALTO_FALTANTE_COLOR' when coalesce(color_balance, 0) = 0 then 'SIN_SOBRANTE_COLOR' else 'CON_SOBRANTE_COLOR' end as risk,
    case when coalesce(variety_balance, 0) < 0 then 'FALTANTE_VARIEDAD' when coalesce(variety_balance, 0) = 0 then 'SIN_SOBRANTE_VARIEDAD' else 'CON_SOBRANTE_VARIEDAD' end as variety_risk
  from demand d left join iv using (demand_date, {ITEM}) left join ic using (demand_date, {COLOR}))
"""
USA = "regexp_matches(upper(coalesce(country, '')), '\\bUSA\\b|UNITED STATES|ESTADOS UNIDOS|EEUU')"
RANK_SQL = f""", ranks as (select {ITEM}, coalesce(s / nullif(sum(s) over (partition by {COLOR}), 0), 0) as variety_share, dense_rank() over (partition by {COLOR} order by s desc) as variety_rank
  from (select {ITEM}, sum(stems) as s from demand where not {USA} group by all))
"""
PRIORITY_SQL = CROSS_SQL + RANK_SQL + f""", judged as (select * exclude (variety_share), coalesce(variety_share, 0) as variety_share, {USA} as usa, order_type in ('SOLIDO', 'SURTIDO', 'SURTIDO_M') as easy,
    order_type = 'RAINBOW' as rainbow, source = 'PENDIENTE_REAL_CLIENTE' as pending from crossed left join ranks using ({ITEM})),
prioritised as (select * exclude (usa, easy, rainbow, pending), case when color_balance < 0 and not usa and easy then least(stems, color_short) else 0 end as stems_to_buy,
    case when risk = 'ALTO_FALTANTE_COLOR' then case when rainbow then 'RAINBOW_NO_COMPRAR_ARMAR_CON_REGLA_GENERAL' when usa then 'USA_VALIDAR_ANTES_DE_COMPRAR'
        when easy and pending then 'ORDEN_REAL_NO_USA_COMPRAR_SOLIDO_SURTIDO_PRIORIDAD_ALTA' when easy and score >= 80 then 'NO_USA_COMPRAR_VARIEDAD_TOP_PRIORIDAD_ALTA'
        when easy and score >= 65 then 'NO_USA_PILOTO_COMPRA_VARIEDAD_TOP' when easy then 'NO_USA_COMPRAR_COLOR_BASE_VALIDAR_VARIEDAD' else 'SIN_PRIORIDAD_COMPRA' end
      when risk = 'SIN_SOBRANTE_COLOR' and pending then 'ORDEN_REAL_PENDIENTE_VIGILAR' when risk = 'SIN_SOBRANTE_COLOR' and score >= 65 then 'VIGILAR_DISPONIBILIDAD' else 'SIN_PRIORIDAD_COMPRA' end as priority,
    case when rainbow then 'no_comprar_rainbow_como_terminado' when usa then 'usa_no_define_compra_variedad' when variety_rank = 1 then 'variedad_top_no_usa'
      when variety_share >= 0.25 then 'variedad_relevante_no_usa' else 'variedad_secundaria_o_sin_demanda_no_usa' end as variety_rule from judged)
"""


def crossed(spark, sf_dir):
    return ops.demand_inventory_cross(demand(spark, sf_dir), inventory(spark, sf_dir))


def prioritised(spark, sf_dir):
    return ops.purchase_priority(crossed(spark, sf_dir))


@query("demand_inventory_cross", with_both(CROSS_SQL + "select * from crossed"))
def demand_inventory_cross(spark, sf_dir):
    return crossed(spark, sf_dir)


@query("variety_demand_rank", with_both(DEMAND_SQL + RANK_SQL + "select * from ranks"))
def variety_demand_rank(spark, sf_dir):
    return ops.variety_demand_rank(demand(spark, sf_dir))


@query("purchase_priority", with_both(PRIORITY_SQL + "select * from prioritised"))
def purchase_priority(spark, sf_dir):
    return prioritised(spark, sf_dir)


for _name, _keys, _k in [
    ("buyer_by_priority", ["priority"], None),
    ("buyer_by_day", ["demand_date", "priority"], None),
    ("buyer_by_item", ["product", "variety", "color", "grade"], 200),
    ("buyer_by_client", ["client_code", "client"], 200),
    ("risk_summary", ["risk", "variety_risk"], None),
    ("priority_summary", ["priority", "variety_rule"], None),
]:
    _list = ", ".join(_keys)
    _limit = f" order by stems_to_buy desc, {_list} limit {_k}" if _k else ""
    query(_name, with_both(PRIORITY_SQL + f"select {_list}, sum(stems) as stems, sum(stems_to_buy) as stems_to_buy, count(*) as lines, count(distinct client_code) as clients from prioritised group by {_list}{_limit}"))(
        lambda spark, sf_dir, keys=_keys, k=_k: ops.buyer(prioritised(spark, sf_dir), keys, k)
    )

BALANCE_SQL = DEMAND_SQL + """, balances as (select demand_date, product, color, sum(balance) as balance from (select inv_date as demand_date, product, color, balance from inv) group by all),
wanted as (select demand_date, product, color, sum(stems) as demand, count(distinct order_id) as orders from demand group by all),
color_days as (select *, greatest(-balance, 0) as short, case when balance < 0 then 'FALTANTE' when balance > 0 then 'SOBRANTE' else 'NEUTRO' end as status
  from (select b.*, coalesce(demand, 0) as demand, coalesce(orders, 0) as orders from balances b left join wanted using (demand_date, product, color)))
"""


def balances(spark, sf_dir):
    return ops.color_balance(demand(spark, sf_dir), inventory(spark, sf_dir))


@query("color_balance", with_both(BALANCE_SQL + "select * from color_days"))
def color_balance(spark, sf_dir):
    return balances(spark, sf_dir)


@query("color_balance_day", with_both(BALANCE_SQL + "select demand_date, status, sum(short) as short, count(*) as colors from color_days group by all"))
def color_balance_day(spark, sf_dir):
    return ops.color_balance_day(balances(spark, sf_dir))


@query("color_shortage_top", with_both(BALANCE_SQL + "select product, color, sum(short) as short, count(distinct demand_date) as days_short from color_days where short > 0 group by all order by short desc, product, color limit 20"))
def color_shortage_top(spark, sf_dir):
    return ops.color_shortage_top(balances(spark, sf_dir))


for _name, _keys in {"shortage_varieties": ["product", "variety", "color"], "shortage_clients": ["client_code", "client"]}.items():
    _list = ", ".join(_keys)
    query(_name, with_both(BALANCE_SQL + f"select {_list}, sum(stems) as stems, count(distinct order_id) as orders from demand semi join (select * from color_days where short > 0) using (demand_date, product, color) group by all"))(
        lambda spark, sf_dir, keys=_keys: ops.shortage_lines(demand(spark, sf_dir), balances(spark, sf_dir), keys)
    )


@query("demand_by_source", with_both(DEMAND_SQL + "select year_week, source, sum(stems) as stems, count(*) as lines from demand group by all"))
def demand_by_source(spark, sf_dir):
    return ops.demand_totals(demand(spark, sf_dir), ["year_week", "source"])


@query("demand_vs_last_year", with_both(DEMAND_SQL + """, now as (select iso_year, iso_week, sum(stems) as stems from demand group by all), past as (select iso_year + 1 as iso_year, iso_week, sum(stems) as last_year from hist group by iso_year, iso_week)
select iso_year, iso_week, stems, coalesce(last_year, 0) as last_year, stems - coalesce(last_year, 0) as difference, (stems - coalesce(last_year, 0)) / nullif(last_year, 0) as pct from now left join past using (iso_year, iso_week)"""))
def demand_vs_last_year(spark, sf_dir):
    return ops.demand_vs_last_year(demand(spark, sf_dir), orders(spark, sf_dir).where("state_canonical = 'confirmado' and stems > 0"))
