"""Order lines and inventory in the raw form of the source extracts, derived from the star-schema tables, and the SQL of
their cleaned form for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bloomline.operators.cleaning import EXPLICIT_MARKS, MARKETS, MARKS, MIXED, OTHER_MARKET, RECIPES, STATES, clean_inventory, clean_orders

RAW_ORDERS = """
select cast(o.o_orderdate as date) as FECHA, cast(o.o_custkey as string) as CODCUSTOM, c.c_name as CLIENTE,
  c.c_mktsegment as SEGMENTO,
  case n.n_nationkey when 1 then 'United States' when 6 then 'Canada' when 3 then 'The Netherlands'
    when 8 then 'Poland' when 2 then 'China' when 7 then 'Japan' when 12 then 'South Korea' else n.n_name end as PAIS,
  r.r_name as CIUDAD, cast(o.o_orderkey as string) as PEDIDO, p.p_type as PRODUCTO, p.p_brand as NomVariedad,
  split_part(p.p_name, ' ', 1) as NomColor, cast(p.p_size % 4 as string) as GRADO,
  case when p.p_size <= 10 then 'QB' when p.p_size <= 30 then 'HB' else 'FB' end as TIPCAJA,
  case p.p_size % 3 when 0 then '10' when 1 then '12.0' else '25' end as TALLXRAM,
  case when p.p_size > 45 then 'Bouquet' else case split_part(p.p_name, ' ', 2)
    when 'anvil' then 'Sólido Por Color' when 'bolt' then 'Sólido Por Variedad' when 'gear' then 'Surtido'
    when 'gizmo' then 'Surtido "M"' when 'plate' then 'Rainbow' when 'ring' then 'Combo Solido' when 'rod' then 'BQT'
    else 'BULK' end end as TIPORDENEMPAQUE,
  o.o_orderpriority as EMPAQUE, concat('R', cast(p.p_size % 7 as string)) as RECETA,
  cast(l.l_linenumber as string) as CajaId, l.l_quantity as TallosPedidos,
  case when l.l_returnflag = 'R' then floor(l.l_quantity * 0.9) else l.l_quantity end as TallosConfirmados,
  l.l_quantity as TOTALTALLOS, floor(l.l_quantity / 10) + 1 as RXCAJA, 1 as FULLES,
  l.l_extendedprice * (1 - l.l_discount) as VENTAS_USD, l.l_extendedprice as VALORTOTAL,
  case when r.r_name = 'EUROPE' then 'EUR' else 'USD' end as NomMoneda,
  case o.o_orderstatus when 'F' then 'Confirmado' when 'O' then 'Pendiente'
    else case o.o_orderpriority when '1-URGENT' then 'Por Verificar' when '2-HIGH' then 'Reproceso'
      else 'En Proceso' end end as ESTADO
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey join {customer} c on o.o_custkey = c.c_custkey
join {nation} n on c.c_nationkey = n.n_nationkey join {region} r on n.n_regionkey = r.r_regionkey
join {part} p on l.l_partkey = p.p_partkey
"""
RAW_INVENTORY = """
select cast(l.l_shipdate as date) as FECHA, p.p_type as PRODUCTO, split_part(p.p_name, ' ', 1) as COLOR,
  p.p_brand as VARIEDAD, cast(p.p_size % 4 as string) as GRADO, s.s_name as CODFINCA,
  case when l.l_linestatus = 'O' then l.l_quantity else -l.l_quantity end as INVENTARIO
from {lineitem} l join {part} p on l.l_partkey = p.p_partkey join {supplier} s on l.l_suppkey = s.s_suppkey
"""
#: The same lines with the words of a part's name split once a part instead of once a line and use.
SPLIT_ORDERS = RAW_ORDERS.replace(
    "join {part} p on", "join (select p_partkey, p_type, p_brand, p_size, split_part(p_name, ' ', 1) as w1, split_part(p_name, ' ', 2) as w2 from {part}) p on"
).replace("split_part(p.p_name, ' ', 1)", "p.w1").replace("split_part(p.p_name, ' ', 2)", "p.w2")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def tables(spark: SparkSession, sf_dir: str, text: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SPLIT_ORDERS, **tables(spark, sf_dir, SPLIT_ORDERS))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_INVENTORY, **tables(spark, sf_dir, RAW_INVENTORY))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(raw_orders(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed lines with stems."""
    return orders(spark, sf_dir).where("state_canonical = 'confirmado' and stems > 0")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_inventory(raw_inventory(spark, sf_dir))


# The same in DuckDB's SQL, written on its own.


def _norm(x: str) -> str:
    plain = f"trim(regexp_replace(strip_accents(lower(cast({x} as varchar))), '\\s+', ' ', 'g'))"
    return f"coalesce(nullif(nullif({plain}, ''), 'nan'), 'sin_info')"


def _key(*parts: str) -> str:
    joined = " || '|' || ".join(f"cast({p} as varchar)" for p in parts)
    return f"coalesce(nullif(trim(regexp_replace(lower({joined}), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'sin_info')"


def _cases(marks, k: int, other: str) -> str:
    when = " ".join(f"when regexp_matches(type_text, '{m[2].replace(chr(39), chr(39) * 2)}') then '{m[k]}'" for m in marks)
    return f"case {when} else '{other}' end"


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


_TEXT = {
    "product": "PRODUCTO", "variety": "NomVariedad", "color": "NomColor", "grade": "GRADO",
    "pack_order_type": "TIPORDENEMPAQUE", "packaging": "EMPAQUE", "recipe": "RECETA", "box_id": "CajaId",
    "box_type": "TIPCAJA", "currency": "NomMoneda", "country": "PAIS", "city": "CIUDAD", "segment": "SEGMENTO",
}
_ABSENT = ["pack_type", "bulk_bouquet", "pack_code", "box_id2", "sleeve", "food"]
_TAIL = ["box_type", "stems_per_bunch", "sleeve", "food", "packaging"]
_KEYS = {
    "sku_finished": ["order_type", "order_subtype", "pack_order_type", "pack_type", "product", "variety", "color", "grade", *_TAIL],
    "sku_flexible": ["order_type", "product", "color", "grade", "box_type", "stems_per_bunch"],
    "structure_key": ["order_type", "order_subtype", "pack_order_type", "pack_type"],
    "product_color": ["product", "color"],
    "product_variety_color": ["product", "variety", "color"],
    "pack_key": ["order_type", *_TAIL],
    "box_key": ["box_id"],
    "recipe_structure_key": ["order_type", "order_subtype", "recipe", *_TAIL],
    "recipe_program_key": ["order_type", "order_subtype", "recipe", "box_type", "sleeve", "food", "packaging"],
}
_GROUP = "client_code, order_date, order_id, order_type, recipe_program_key, box_key"
_STATE = " ".join(f"when '{a}' then '{b}'" for a, b in STATES.items())

ORDERS_SQL = f"""
raw as ({RAW_ORDERS.format(**{t: t for t in TABLES})}),
typed as (
  select FECHA as order_date, {_norm("CODCUSTOM")} as client_code, {_norm("CLIENTE")} as client, PEDIDO as order_id,
    {", ".join(f"{_norm(x)} as {n}" for n, x in _TEXT.items())}, {", ".join(f"'sin_info' as {n}" for n in _ABSENT)},
    cast(TallosPedidos as double) as stems_ordered, cast(TallosConfirmados as double) as stems_confirmed,
    cast(TOTALTALLOS as double) as stems_total, cast(RXCAJA as double) as bunches_per_box,
    regexp_replace(cast(cast(TALLXRAM as double) as varchar), '\\.0$', '') as stems_per_bunch,
    cast(TALLXRAM as double) as bunch_size, cast(FULLES as double) as program_boxes,
    cast(VENTAS_USD as double) as sales_usd, cast(VALORTOTAL as double) as total_value,
    case {_norm("ESTADO")} {_STATE} else 'otro' end as state_canonical
  from raw
),
measured as (
  select *, case when stems_ordered > 0 then stems_ordered else stems_total end as stems,
    client_code || ' | ' || client as client_key,
    cast(isoyear(order_date) as integer) as iso_year, cast(week(order_date) as integer) as iso_week,
    isoyear(order_date) || '-W' || lpad(cast(week(order_date) as varchar), 2, '0') as year_week,
    cast(month(order_date) as integer) as month, cast(isodow(order_date) as integer) as dow, dayname(order_date) as day_name,
    cast(date_trunc('week', order_date) as date) as week_start,
    case state_canonical when 'confirmado' then 'historico_real_despachado' when 'pendiente' then 'orden_real_futura_cliente'
      when 'en_proceso' then 'estimado_comercial' when 'otro' then 'otro_no_clasificado'
      else 'cambio_sobre_confirmado' end as state_category,
    concat_ws(' ', pack_order_type, pack_type, packaging, recipe, bulk_bouquet, pack_code, box_id) as type_text
  from typed
),
kinds as (
  select *, greatest(stems - stems_confirmed, 0) as shortfall,
    case when stems > 0 then stems_confirmed / stems end as fulfilment,
    {_cases(MARKS, 0, "OTRO_NO_CLASIFICADO").replace("case ", "case " + " ".join(f"when regexp_matches(type_text, '{m[2]}') then '{m[0]}'" for m in EXPLICIT_MARKS) + " ", 1)} as order_type,
    {_cases(MARKS, 1, "sin_info").replace("case ", "case " + " ".join(f"when regexp_matches(type_text, '{m[2]}') then '{m[1]}'" for m in EXPLICIT_MARKS) + " ", 1)} as order_subtype
  from measured
),
keyed as (
  select *, {", ".join(f"{_key(*v)} as {k}" for k, v in _KEYS.items())},
    case when order_type = 'SOLIDO' then 'SKU_SOLIDO_COLOR_CAJA' when order_type in ('SURTIDO', 'SURTIDO_M') then 'ESTRUCTURA_MEZCLA_COLOR_COMPONENTE'
      when order_type = 'RAINBOW' then 'RECETA_RAINBOW_COLOR_COMPONENTE' when order_type = 'BQT' then 'RECETA_BQT_ESTRUCTURA'
      when order_type = 'BOUQUET' then 'RECETA_BOUQUET_ESTRUCTURA' when order_type = 'COMBO' then 'COMBO_ESTRUCTURA_CAJA'
      when order_type = 'BULK' then 'BULK_PRODUCTO_COLOR' else 'REVISION_OPERATIVA' end as focus,
    case when order_type = 'SOLIDO' then 'COLOR_DEFINITORIO_SKU' when order_type in ({_quoted(MIXED)}) then 'COLOR_COMPONENTE_ESTRUCTURA'
      when order_type = 'BULK' then 'COLOR_BASE_VOLUMEN' else 'COLOR_REFERENCIAL' end as color_role,
    case when order_type = 'SOLIDO' then 'SOLIDOS_COLOR_CAJA' when order_type in ({_quoted(MIXED)}) then 'ESTRUCTURAS_MIXTAS_RECETA'
      when order_type = 'BULK' then 'BULK_COLOR_BASE' else 'OTROS_FORMATOS' end as family
  from kinds
),
boxes as (
  select {_GROUP}, sum(stems) / max(program_boxes) as program_box_stems, sum(bunches_per_box) as program_bunches
  from keyed where order_type in ({_quoted(RECIPES)}) group by {_GROUP}
),
sized as (
  select k.*, b.program_box_stems, b.program_bunches, b.program_box_stems / b.program_bunches as program_bunch_stems,
    {_key("recipe_program_key", "'tallos_ramo_programa_' || coalesce(regexp_replace(cast(round_even(b.program_box_stems / b.program_bunches, 6) as varchar), '\\.0+$', ''), 'sin_tamano')")} as recipe_size_key,
    {_key("order_type", "order_subtype", "pack_order_type", "pack_type", "packaging", "product", "box_type", "stems_per_bunch", "sleeve", "food", "recipe", "pack_code", "bulk_bouquet", "box_key")} as sku_composition
  from keyed k left join boxes b using ({_GROUP})
),
clean as (
  select *, case when order_type in ('SOLIDO', 'BULK') then product_color when order_type in ({_quoted(RECIPES)}) then recipe_size_key
      when order_type in ('SURTIDO', 'SURTIDO_M') then recipe_structure_key else structure_key end as analysis_key,
    case when order_type in ('SOLIDO', 'BULK') then product_color when order_type in ({_quoted(RECIPES)}) then recipe_size_key
      when order_type in ('SURTIDO', 'SURTIDO_M') then sku_composition else structure_key end as sku_operational
  from sized where stems > 0 or sales_usd <> 0 or total_value <> 0
),
hist as (select * from clean where state_canonical = 'confirmado' and stems > 0)"""
INVENTORY_SQL = f"""
raw_inv as ({RAW_INVENTORY.format(**{t: t for t in TABLES})}),
inv as (
  select FECHA as inv_date, {_norm("PRODUCTO")} as product, {_norm("VARIEDAD")} as variety, {_norm("COLOR")} as color,
    {_norm("GRADO")} as grade, {_norm("CODFINCA")} as farm, cast(INVENTARIO as double) as balance,
    cast(isoyear(FECHA) as integer) as iso_year, cast(week(FECHA) as integer) as iso_week,
    isoyear(FECHA) || '-W' || lpad(cast(week(FECHA) as varchar), 2, '0') as year_week,
    {_key(_norm("PRODUCTO"), _norm("COLOR"))} as product_color,
    {_key(_norm("PRODUCTO"), _norm("VARIEDAD"), _norm("COLOR"))} as product_variety_color
  from raw_inv
)"""


def with_orders(query: str) -> str:
    """query may read clean (all lines) and hist (confirmed lines with stems)."""
    return f"with {ORDERS_SQL}\n{query}"


def with_inventory(query: str) -> str:
    return f"with {INVENTORY_SQL}\n{query}"


def with_both(query: str) -> str:
    return f"with {ORDERS_SQL},{INVENTORY_SQL}\n{query}"


def market_sql(country: str) -> str:
    when = " ".join(f"when lower(trim({country})) in ({_quoted(names)}) then '{m}'" for m, names in MARKETS.items())
    return f"case {when} else '{OTHER_MARKET}' end"
