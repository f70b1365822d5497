"""Order lines and inventory balances: aliases, types, states, order types and keys, as one lazy plan per table."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from bloomline.functions.text import (
    MISSING, calendar, combine_key, date_from, join_parts, key_part, normalize_client_code, normalize_text, part_of, to_number,
)

# Spellings of source columns (compared without case and separators) and their names here.
ORDER_ALIASES = {
    "order_date": ["fecha"], "client_code": ["codcustom", "codcliente"], "client": ["cliente"],
    "subclient": ["subcliente"], "client_group": ["grupo"], "seller": ["vendedor"], "order_id": ["pedido"],
    "product": ["producto"], "variety": ["nomvariedad", "variedad"], "color": ["nomcolor", "color"],
    "grade": ["grado", "tamano"], "pack_order_type": ["tipordenempaque"], "pack_type": ["tipempaque"],
    "packaging": ["empaque"], "recipe": ["receta"], "bulk_bouquet": ["bulkbouquet"], "pack_code": ["codempaque"],
    "box_id": ["cajaid"], "box_id2": ["idcaja"], "box_type": ["tipcaja"], "stems_per_bunch": ["tallxram", "txramo"],
    "sleeve": ["capuchon"], "food": ["comida"], "stems_ordered": ["tallospedidos"],
    "stems_confirmed": ["tallosconfirmados"], "stems_total": ["totaltallos"], "bunches_per_box": ["rxcaja"],
    "bunches_per_box_detail": ["rxcajadetalle"], "pieces": ["piezas"], "fulls": ["fulles"],
    "equivalence": ["equivalencia"], "bunches_ordered": ["totramped"], "bunches_confirmed": ["totramconf"],
    "sales_usd": ["ventasusd"], "unit_value": ["valorunitario"], "total_value": ["valortotal"],
    "currency": ["nommoneda"], "country": ["pais"], "city": ["ciudad"], "farm": ["finca"], "state": ["estado"],
    "segment": ["segmento"],
}
INVENTORY_ALIASES = {
    "product": ["producto"], "color": ["color"], "variety": ["variedad"], "grade": ["grado"],
    "balance": ["inventario"], "farm": ["codfinca"], "inv_date": ["fecha"],
}
# States, their meaning, and order types.
STATES = {
    "confirmado": "confirmado", "pendiente": "pendiente", "en proceso": "en_proceso", "proceso": "en_proceso",
    "por verificar": "por_verificar", "reproceso": "reproceso",
}
STATE_CATEGORIES = {
    "confirmado": "historico_real_despachado", "pendiente": "orden_real_futura_cliente",
    "en_proceso": "estimado_comercial", "por_verificar": "cambio_sobre_confirmado",
    "reproceso": "cambio_sobre_confirmado", "otro": "otro_no_clasificado",
}
ORDER_TYPES = ["SOLIDO", "SURTIDO", "SURTIDO_M", "RAINBOW", "BOUQUET", "BQT", "COMBO", "BULK"]
MIXED = ["SURTIDO", "SURTIDO_M", "RAINBOW", "BOUQUET", "BQT", "COMBO"]
RECIPES = ["RAINBOW", "BOUQUET", "BQT", "COMBO"]
# The strongest mark first; the words are fixed values.
EXPLICIT_MARKS = [
    ("COMBO", "combo", r"\bcombo\b"),
    ("BQT", "bqt", r"\bbqt\b"),
    ("RAINBOW", "rainbow", r"\brainbow\b"),
]
MARKS = [
    ("SURTIDO_M", "surtido_m", r"""surtido\s*["']?m["']?\b|mixed\s*m\b|\bmixed\s+special\b"""),
    ("SURTIDO", "surtido_general", r"\bsurtido\b|\bmixed\b|\bmix\b|\bassorted\b|\bassort\b|\basstd\b"),
    ("BOUQUET", "bouquet", r"\bbouquet\b"),
    ("SOLIDO", "solido_por_variedad", r"solido\s+por\s+variedad|solid\s+by\s+variety"),
    ("SOLIDO", "solido_por_color", r"solido\s+por\s+color|solid\s+by\s+color"),
    ("SOLIDO", "solido_general", r"\bsolido\b|\bsolid\b"),
    ("BULK", "bulk", r"\bbulk\b|\bbulkbouquet\b"),
]
#: A text without any of these has no such mark: cheaper to tell than by the pattern.
HINTS = {"surtido_m": ["surtido", "mixed"], "surtido_general": ["surtido", "mix", "assort", "asstd"], **{f"solido_{x}": ["solid"] for x in ("por_variedad", "por_color", "general")}}
TYPE_FIELDS = ["pack_order_type", "pack_type", "packaging", "recipe", "bulk_bouquet", "pack_code", "box_id"]
NUMBERS = [
    "stems_ordered", "stems_confirmed", "stems_total", "stems_per_bunch", "bunches_ordered", "bunches_confirmed",
    "bunches_per_box", "bunches_per_box_detail", "pieces", "fulls", "equivalence", "sales_usd", "unit_value", "total_value",
]
TEXTS = [
    "subclient", "client_group", "seller", "product", "variety", "color", "grade", "pack_order_type", "pack_type",
    "packaging", "recipe", "bulk_bouquet", "pack_code", "box_id", "box_id2", "box_type", "sleeve", "food", "currency",
    "country", "city", "farm", "segment",
]
REFERENCE_LEVELS = {
    "exact": ["order_date", "client_code", "order_id", "box_key", "product", "variety", "color", "grade", "box_type"],
    "stable": ["client_code", "box_key", "product", "variety", "color"],
    "box": ["client_code", "box_key"],
}


def resolve_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Renames source columns; the first spelling that is there wins, and a column named right already stays."""
    plain = {}
    for c in df.columns:
        plain.setdefault("".join(ch for ch in c.lower() if ch.isalnum()), c)
    have, renamed = {c.lower() for c in df.columns}, {}
    for name, spellings in aliases.items():
        found = next((plain[s] for s in spellings if s in plain), None)
        if name not in have and found:
            renamed[found] = name
    return df.withColumnsRenamed(renamed)


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in have})


def _mapped(pairs: dict[str, str], x: Column, default: str) -> Column:
    entries = [F.lit(v) for kv in pairs.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*entries), x), F.lit(default))


def classify_state(df: DataFrame) -> DataFrame:
    """state normalised, and what it means. In steps, so that each reads the one before instead of repeating it."""
    named = df.withColumn("state", normalize_text(F.col("state")))
    canonical = F.col("state_canonical")
    return named.withColumn("state_canonical", _mapped(STATES, F.col("state"), "otro")).withColumns(
        {
            "state_category": _mapped(STATE_CATEGORIES, canonical, "otro_no_clasificado"),
            "is_history": canonical == "confirmado",
            "is_future_order": canonical == "pendiente",
            "is_estimate": canonical == "en_proceso",
            "is_change": canonical.isin("por_verificar", "reproceso"),
        }
    )


def _marked(raw: Column, mark: tuple[str, str, str]) -> Column:
    hints = [F.contains(raw, F.lit(h)) for h in HINTS.get(mark[1], [mark[1]])]
    return functools.reduce(lambda a, b: a | b, hints) & raw.rlike(mark[2])


def _first_mark(raw: Column, marks) -> Column:
    """Place of the first mark that the text has, from 1; null for none."""
    out = F.when(_marked(raw, marks[0]), 1)
    for k, m in enumerate(marks[1:], 2):
        out = out.when(_marked(raw, m), k)
    return out


def _of_mark(marks, column: int, place: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(m[column]) for m in marks]), place)


def classify_order_type(df: DataFrame) -> DataFrame:
    """Adds order type, subtype and what follows from them. reference_type, if there, beats the general marks; combo,
    bqt and rainbow beat it, in this order."""
    named = F.upper(F.coalesce(F.col("reference_type"), F.lit(""))) if "reference_type" in df.columns else F.lit("")
    known = named.isin(ORDER_TYPES)
    marked = df.withColumn("type_text", F.concat_ws(" ", *TYPE_FIELDS)).withColumn("strong", _first_mark(F.col("type_text"), EXPLICIT_MARKS))
    marked = marked.withColumn("mark", F.when(F.col("strong").isNull() & ~known, _first_mark(F.col("type_text"), MARKS)))
    strong, mark = F.col("strong"), F.col("mark")
    typed = marked.withColumns(
        {
            "order_type": F.coalesce(
                _of_mark(EXPLICIT_MARKS, 0, strong), F.when(known, named), _of_mark(MARKS, 0, mark), F.lit("OTRO_NO_CLASIFICADO")
            ),
            "order_subtype": F.coalesce(
                _of_mark(EXPLICIT_MARKS, 1, strong), F.when(known, "referencia_historica"), _of_mark(MARKS, 1, mark), F.lit(MISSING)
            ),
            "type_origin": F.when(strong.isNotNull(), "marca_explicita_fuente")
            .when(known, "referencia_historica_no_ambigua").otherwise("regla_campos_fuente"),
        }
    ).drop("type_text", "strong", "mark")
    kind, sub = F.col("order_type"), F.col("order_subtype")
    return typed.withColumns(
        {
            "ease": F.when(kind.isin("SOLIDO", "SURTIDO", "SURTIDO_M"), "FACIL_COMPRAR_TERMINADO")
            .when(kind == "RAINBOW", "NO_COMPRAR_RAINBOW_ARMAR_INTERNO")
            .when(kind.isin("COMBO", "BULK", "BOUQUET", "BQT"), "VALIDAR_FORMATO_ANTES_COMPRAR")
            .otherwise("REVISAR_OPERACION"),
            "availability_level": F.when((kind == "SOLIDO") & (sub == "solido_por_variedad"), "COLOR_VARIEDAD")
            .when(kind == "RAINBOW", "REGLA_GENERAL_PEDIDO").otherwise("COLOR"),
            "focus": F.when(kind == "SOLIDO", "SKU_SOLIDO_COLOR_CAJA")
            .when(kind.isin("SURTIDO", "SURTIDO_M"), "ESTRUCTURA_MEZCLA_COLOR_COMPONENTE")
            .when(kind == "RAINBOW", "RECETA_RAINBOW_COLOR_COMPONENTE").when(kind == "BQT", "RECETA_BQT_ESTRUCTURA")
            .when(kind == "BOUQUET", "RECETA_BOUQUET_ESTRUCTURA").when(kind == "COMBO", "COMBO_ESTRUCTURA_CAJA")
            .when(kind == "BULK", "BULK_PRODUCTO_COLOR").otherwise("REVISION_OPERATIVA"),
            "color_role": F.when(kind == "SOLIDO", "COLOR_DEFINITORIO_SKU")
            .when(kind.isin(MIXED), "COLOR_COMPONENTE_ESTRUCTURA").when(kind == "BULK", "COLOR_BASE_VOLUMEN")
            .otherwise("COLOR_REFERENCIAL"),
            "family": F.when(kind == "SOLIDO", "SOLIDOS_COLOR_CAJA").when(kind.isin(MIXED), "ESTRUCTURAS_MIXTAS_RECETA")
            .when(kind == "BULK", "BULK_COLOR_BASE").otherwise("OTROS_FORMATOS"),
            "is_solid": kind == "SOLIDO",
            "is_rainbow": kind == "RAINBOW",
        }
    )


def build_type_reference(enriched: DataFrame) -> dict[str, DataFrame]:
    """Per key level the order type of keys that have one type only. enriched: order_type and the keys."""
    kind = F.upper(F.col("order_type"))
    valid = enriched.withColumn("order_type", kind).where(kind.isin(ORDER_TYPES))
    out = {}
    for level, keys in REFERENCE_LEVELS.items():
        filled = [F.col(k) if k == "order_date" else F.coalesce(F.col(k), F.lit(MISSING)).alias(k) for k in keys]
        groups = valid.groupBy(*filled).agg(F.min("order_type").alias("reference_type"), F.max("order_type").alias("other"))
        out[level] = groups.where("reference_type = other").drop("other")
    return out


def attach_type_reference(df: DataFrame, reference: dict[str, DataFrame]) -> DataFrame:
    """reference_type from the most exact level that knows the line. Spark broadcasts a level only if it is small."""
    out, found = df, []
    for level, keys in REFERENCE_LEVELS.items():
        out = out.join(reference[level].withColumnRenamed("reference_type", f"type_{level}"), keys, "left")
        found.append(f"type_{level}")
    return out.withColumn("reference_type", F.coalesce(*found)).drop(*found)


def parse_dates(df: DataFrame, column: str) -> DataFrame:
    """The column as dates, rows without one dropped. Months come first unless more than half fail that way."""
    if df.schema[column].dataType.typeName() in ("date", "timestamp"):
        return df.withColumn(column, F.col(column).cast("date")).where(F.col(column).isNotNull())
    failed = df.agg(F.avg(date_from(F.col(column), False).isNull().cast("int")).alias("share")).first().share
    return df.withColumn(column, date_from(F.col(column), (failed or 0) > 0.5)).where(F.col(column).isNotNull())


def typed_orders(raw: DataFrame) -> DataFrame:
    """Raw lines with this engine's names, types and normalised texts, calendar, states and quantities."""
    named = resolve_aliases(raw, ORDER_ALIASES)
    have = {c.lower() for c in named.columns}
    dated = parse_dates(ensure_columns(named, list(ORDER_ALIASES)), "order_date")
    dated = dated.withColumn("client_code", normalize_client_code(F.col("client_code")))
    schema = dated.schema

    def number(c: str) -> Column:
        """Numbers need no reading as text."""
        if c not in have:
            return F.lit(0.0)
        return F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) if isinstance(schema[c].dataType, NumericType) else to_number(F.col(c))

    typed = dated.select(
        "order_date",
        normalize_text(F.col("client_code")).alias("client_code"),
        normalize_text(F.col("client")).alias("client"),
        F.coalesce(F.col("order_id").cast("string"), F.lit(MISSING)).alias("order_id"),
        *[(normalize_text(F.col(c)) if c in have else F.lit(MISSING)).alias(c) for c in TEXTS],
        *[number(c).alias(c) for c in NUMBERS],
        "state",
        *[x.alias(n) for n, x in calendar(F.col("order_date")).items()],
    )
    typed = typed.withColumn("client_code", F.when(F.col("client_code") == MISSING, F.col("client")).otherwise(F.col("client_code")))
    # Of two normalised texts: nothing is left to normalise.
    typed = typed.withColumn("client_key", F.concat("client_code", F.lit(" | "), "client"))
    return order_measures(classify_state(typed))


def order_measures(df: DataFrame) -> DataFrame:
    """Official quantity (ordered, else total stems), shortfall, fulfilment, stems of the box and boxes of the program."""
    stems = F.when(F.col("stems_ordered") > 0, F.col("stems_ordered")).otherwise(F.col("stems_total"))
    factor = F.when(F.col("fulls") > 0, F.col("fulls")).otherwise(F.col("pieces"))
    sized = F.regexp_replace(F.bround("stems_per_bunch", 6).cast("string"), "\\.0$", "")
    return df.withColumns(
        {
            "stems": stems,
            "shortfall": F.greatest(stems - F.col("stems_confirmed"), F.lit(0.0)),
            "fulfilment": F.when(stems > 0, F.col("stems_confirmed") / stems),
            "box_component_stems": F.col("bunches_per_box") * F.col("stems_per_bunch"),
            "program_boxes": F.when(factor > 0, factor),
            "stems_per_bunch": sized,
        }
    )


def with_parts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column as a part of keys, part_<column>, in a step of its own so that no key makes it again. Labels have no other characters."""
    part = lambda c: F.lower(c) if c in ("order_type", "order_subtype") else part_of(c)
    return df.withColumns({f"part_{c}": part(c) for c in dict.fromkeys(columns)})


def key_of_parts(columns: list[str], *more: str) -> Column:
    """A key with the order type in it is never empty."""
    names = [f"part_{c}" for c in columns] + list(more)
    joined = F.concat_ws("_", *names)
    if "order_type" in columns:
        return joined
    return F.when(functools.reduce(lambda a, b: a & b, [F.col(n).isNull() for n in names]), MISSING).otherwise(joined)


def with_box_key(df: DataFrame) -> DataFrame:
    parts = df.withColumns({"part_box": part_of("box_id"), "part_box2": part_of("box_id2")})
    other = F.coalesce("part_box2", F.lit(MISSING))
    return parts.withColumn("box_key", F.when(F.col("part_box").isin(MISSING, "nan", "none"), other).otherwise(F.coalesce("part_box", other))).drop("part_box", "part_box2")


TAIL = ["box_type", "stems_per_bunch", "sleeve", "food", "packaging"]
RECIPE_PROGRAM = ["order_type", "order_subtype", "recipe", "box_type", "sleeve", "food", "packaging"]
KEYS = {
    "sku_finished": ["order_type", "order_subtype", "pack_order_type", "pack_type", "product", "variety", "color", "grade", *TAIL],
    "sku_flexible": ["order_type", "product", "color", "grade", "box_type", "stems_per_bunch"],
    "structure_key": ["order_type", "order_subtype", "pack_order_type", "pack_type"],
    "product_color": ["product", "color"],
    "product_variety_color": ["product", "variety", "color"],
    "pack_key": ["order_type", *TAIL],
    "recipe_structure_key": ["order_type", "order_subtype", "recipe", *TAIL],
    "recipe_program_key": RECIPE_PROGRAM,
    "color_component_key": ["order_type", "order_subtype", "pack_order_type", "pack_type", "product", "color", "grade", "box_type"],
}
COMPOSITION = ["order_type", "order_subtype", "pack_order_type", "pack_type", "packaging", "product", "box_type", "stems_per_bunch", "sleeve", "food", "recipe", "pack_code", "bulk_bouquet"]


def operational_keys(df: DataFrame) -> DataFrame:
    """All keys that need no grouping. Each column is made a part of keys once."""
    used = list(dict.fromkeys(c for columns in [*KEYS.values(), COMPOSITION] for c in columns))
    boxed = df if "box_key" in df.columns else with_box_key(df)
    keys = {k: key_of_parts(columns) for k, columns in KEYS.items()} | {"sku_composition": key_of_parts(COMPOSITION, "box_key")}
    return with_parts(boxed, used).withColumns(keys).drop(*[f"part_{c}" for c in used])


RECIPE_GROUP = ["client_code", "order_date", "order_id", "order_type", "recipe_program", "box_key"]


def recipe_program_size(df: DataFrame) -> DataFrame:
    """Per recipe box: stems of the box, bunches and stems per bunch; null for other order types, whose lines need no program's key.

    Windows rather than an aggregate and a join back: the lines are cleaned once and shuffled once, before they get their keys, which are
    longer than all that they are made of."""
    recipe = F.col("order_type").isin(RECIPES)
    boxed = df if "box_key" in df.columns else with_box_key(df)
    keyed = with_parts(boxed, RECIPE_PROGRAM).withColumn("recipe_program", F.when(recipe, key_of_parts(RECIPE_PROGRAM)))
    keyed = keyed.drop(*[f"part_{c}" for c in RECIPE_PROGRAM])
    box = Window.partitionBy(*RECIPE_GROUP)
    summed = keyed.withColumns(
        {
            "program_total": F.sum("stems").over(box),
            "program_box_count": F.max("program_boxes").over(box),
            "component_stems": F.when(recipe, F.sum("box_component_stems").over(box)),
            "program_detail": F.sum("bunches_per_box_detail").over(box),
            "program_per_box": F.sum("bunches_per_box").over(box),
        }
    )
    stems = F.coalesce(F.try_divide("program_total", "program_box_count"), F.col("component_stems"))
    bunches = F.when(F.col("program_detail") > 0, F.col("program_detail")).otherwise(F.col("program_per_box"))
    sized = summed.withColumns({"program_box_stems": F.when(recipe, stems), "program_bunches": F.when(recipe, bunches)})
    sized = sized.withColumn("program_bunch_stems", F.try_divide("program_box_stems", "program_bunches"))
    return sized.drop("recipe_program", "program_total", "program_box_count", "program_detail", "program_per_box")


def operational_sku(df: DataFrame) -> DataFrame:
    """df: operational_keys of recipe_program_size."""
    kind = F.col("order_type")
    size = F.coalesce(F.regexp_replace(F.bround("program_bunch_stems", 6).cast("string"), "\\.0+$", ""), F.lit("sin_tamano"))
    sized = df.withColumn("recipe_size_key", F.concat_ws("_", "recipe_program_key", F.lit("tallos_ramo_programa"), key_part(F.lower(size))))
    by_color = kind.isin("SOLIDO", "BULK")
    analysis = (
        F.when(by_color, F.col("product_color"))
        .when(kind.isin(RECIPES), F.col("recipe_size_key"))
        .when(kind.isin(MIXED), F.col("recipe_structure_key"))
        .otherwise(F.col("structure_key"))
    )
    instance = join_parts(part_of("client_code"), F.date_format("order_date", "yyyy_MM_dd"), part_of("order_id"), "sku_composition")
    return sized.withColumns({"order_instance": instance, "analysis_key": analysis}).withColumn(
        "sku_operational", F.when(kind.isin("SURTIDO", "SURTIDO_M"), F.col("sku_composition")).otherwise(F.col("analysis_key"))
    )


def keep_physical_or_value(df: DataFrame) -> DataFrame:
    return df.where((F.col("stems") > 0) | (F.col("sales_usd") != 0) | (F.col("total_value") != 0))


def clean_orders(raw: DataFrame, reference: dict[str, DataFrame] | None = None) -> DataFrame:
    """All of the above in one plan: one shuffle for the recipe boxes, the rest is projection and filter."""
    typed = typed_orders(raw)
    if reference:
        typed = attach_type_reference(with_box_key(typed), reference)
    return keep_physical_or_value(operational_sku(operational_keys(recipe_program_size(classify_order_type(typed)))))


def clean_inventory(raw: DataFrame) -> DataFrame:
    named = parse_dates(ensure_columns(resolve_aliases(raw, INVENTORY_ALIASES), list(INVENTORY_ALIASES)), "inv_date")
    texts = ["product", "variety", "color", "grade", "farm"]
    keyed = named.select("inv_date", *[normalize_text(F.col(c)).alias(c) for c in texts], to_number(F.col("balance")).alias("balance"))
    days = calendar(F.col("inv_date"))
    return keyed.withColumns({n: days[n] for n in ("iso_year", "iso_week", "year_week")}).withColumns(
        {"product_color": combine_key("product", "color"), "product_variety_color": combine_key("product", "variety", "color")}
    )


def split_by_state(df: DataFrame) -> dict[str, DataFrame]:
    state = F.col("state_canonical")
    return {
        "all": df,
        "confirmed": df.where(state == "confirmado"),
        "pending": df.where(state == "pendiente"),
        "estimates": df.where(state == "en_proceso"),
        "changes": df.where(state.isin("por_verificar", "reproceso")),
        "other": df.where(state == "otro"),
    }


def state_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("state_canonical", "state_category").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("client_code").alias("clients"),
        F.sum("stems").alias("stems"),
        F.min("order_date").alias("date_min"),
        F.max("order_date").alias("date_max"),
    )


def confirmed_history(df: DataFrame, physical: bool = True) -> DataFrame:
    """Confirmed lines, or all where nothing is confirmed; physical: with stems only."""
    confirmed = df.where(F.col("state_canonical") == "confirmado")
    chosen = confirmed if confirmed.limit(1).count() else df
    return chosen.where(F.col("stems") > 0) if physical else chosen


def filter_years(df: DataFrame, years: list[int], column: str = "order_date") -> DataFrame:
    return df.where(F.year(column).isin(years))


# Countries of each market; all others are the last one.
MARKETS = {
    "01_ESTADOS_UNIDOS_CANADA": ["united states", "usa", "u.s.a.", "us", "canada"],
    "02_THE_NETHERLANDS": ["the netherlands", "netherlands", "holland", "holanda"],
    "03_POLONIA": ["poland", "polonia"],
    "04_ASIA": [
        "china", "hong kong", "japan", "singapore", "south korea", "korea", "taiwan", "thailand", "vietnam", "malaysia",
        "indonesia", "philippines", "india", "united arab emirates", "uae", "qatar", "saudi arabia",
    ],
}
OTHER_MARKET = "05_OTROS"


def classify_market(country: Column) -> Column:
    text, out = F.lower(F.trim(F.coalesce(country, F.lit("")))), None
    for market, names in MARKETS.items():
        out = F.when(text.isin(names), market) if out is None else out.when(text.isin(names), market)
    return out.otherwise(OTHER_MARKET)
