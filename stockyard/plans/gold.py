"""Gold: star schema with point-in-time keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.functions.hashing import row_hash, unknown_hash
from stockyard.operators.asof import asof_join, or_unknown
from stockyard.operators.keys import highest_key, literal_row, with_member
from stockyard.operators.scd2 import current_versions
from stockyard.operators.skew import lookup
from stockyard.operators.upsert import upsert, upsert_numbered
from stockyard.plans.silver import BRANCH_HASH, CUSTOMER_HASH
from stockyard.schemas import conform

VALIDITY = ["effective_start", "effective_end"]


def _cells(values: dict) -> dict[str, Column]:
    return {name: F.lit(v) for name, v in values.items()}


# --- dimensions -----------------------------------------------------------------------------

def _current_snapshot(history: DataFrame, nk: str, attributes: list[str]) -> DataFrame:
    """Current versions under ``nk_…``, hashed together with their validity."""
    current = current_versions(history)
    hashed = current.withColumn("row_hash", row_hash(current, attributes + VALIDITY))
    return hashed.withColumnRenamed(nk, f"nk_{nk}").drop("is_current")


def _with_unknown_version(dim: DataFrame, sk: str, nk: str, name_column: str, name: str) -> DataFrame:
    cells = _cells({sk: V.UNKNOWN_SK, nk: V.UNKNOWN_KEY, name_column: name,
                    "effective_start": V.UNKNOWN_START, "effective_end": V.OPEN_END})
    return with_member(dim, nk, {**cells, "row_hash": unknown_hash(V.UNKNOWN_KEY)})


def current_customers(target: DataFrame, history: DataFrame) -> DataFrame:
    """Customers as of now; a new version's key replaces the old one. Unknown member has key 0."""
    merged = upsert(target, _current_snapshot(history, "customer_id", CUSTOMER_HASH), ["nk_customer_id"], source_unique=True)
    return _with_unknown_version(merged, "customer_sk", "nk_customer_id", "customer_name", V.UNKNOWN_NAME_M)


def current_branches(target: DataFrame, history: DataFrame) -> DataFrame:
    merged = upsert(target, _current_snapshot(history, "branch_id", BRANCH_HASH), ["nk_branch_id"], source_unique=True)
    return _with_unknown_version(merged, "branch_sk", "nk_branch_id", "branch_name", V.UNKNOWN_NAME_F)


def current_companies(target: DataFrame, history: DataFrame) -> DataFrame:
    """Enriched branches as of now, updated on every match."""
    merged = upsert(target, current_versions(history), ["cod_filial"], guard="always", source_unique=True)
    return with_member(merged, "cod_filial", _cells({
        "empresa_sk": V.UNKNOWN_SK, "codigo": 0, "nome": V.UNKNOWN_NAME_F, "empresa_estoque": 0,
        "cod_filial": V.UNKNOWN_KEY, "razao_social": V.UNKNOWN_NAME_F, "porte": V.UNKNOWN_NAME_M}))


def product_dimension(target: DataFrame, silver_products: DataFrame, unknown_sk: int | None = None) -> DataFrame:
    """Products with a stable key. The unknown product takes the next key, or ``unknown_sk`` if given."""
    source = silver_products.withColumnRenamed("product_id", "nk_product_id")
    merged = upsert_numbered(target, source, ["nk_product_id"], "product_sk", source_unique=True)
    cells = {**_cells({"nk_product_id": V.UNKNOWN_KEY, "product_name": V.UNKNOWN_NAME_M}), "row_hash": unknown_hash(V.UNKNOWN_KEY)}
    sk = highest_key(merged, "product_sk") + 1 if unknown_sk is None else unknown_sk
    return with_member(merged, "nk_product_id", {**cells, "product_sk": F.lit(sk)})


def opening_hours_dimension(silver_hours: DataFrame) -> DataFrame:
    """Full refresh, so the unknown row is simply added."""
    unknown = _cells({"cod_filial": V.UNKNOWN_KEY, "filial": V.UNKNOWN_NAME_F, "pausa_para_almoco": False,
                      "supervisor": V.UNKNOWN_NAME_M, **V.UNKNOWN_OPENING_HOURS})
    return silver_hours.unionByName(literal_row(silver_hours, unknown))


def numbered_companies(target: DataFrame, enriched: DataFrame) -> DataFrame:
    """Silver company history: one row per branch version, updated on every match."""
    return upsert_numbered(target, enriched, ["cod_filial", "effective_start"], "empresa_sk", guard="always", source_unique=True)


# --- fact -------------------------------------------------------------------------------------

def line_totals(lines: DataFrame, products: DataFrame, hot_items: dict | None = None) -> DataFrame:
    """Distinct items, pieces and gross weight per picklist; an unknown item weighs nothing.

    Lines are first reduced to one row per (picklist, item), which also spreads a huge
    picklist over its items. Weights depend on the item only, so weighing the sums is exact.
    """
    items = lines.groupBy("pick_list_id", "item_code").agg(F.sum("pick_quantity").alias("pieces"))
    weights = products.select(F.col("nk_product_id").alias("__item"), "weight")
    weighed = lookup(items, weights, "item_code", "__item", hot=hot_items, spread="pick_list_id")
    weight = F.coalesce(F.col("pieces"), F.lit(0)) * F.coalesce(F.col("weight"), F.lit(0))
    return weighed.groupBy("pick_list_id").agg(
        F.count("item_code").alias("QtdSKU"),
        F.sum("pieces").cast("decimal(18,2)").alias("QtdPecas"),
        F.sum(weight).cast("decimal(18,4)").alias("PesoBruto"),
    )


def wanted_totals(picklists: DataFrame, lines: DataFrame, products: DataFrame, hot_items: dict | None = None) -> DataFrame:
    """``line_totals`` of the ``picklists`` (``pick_list_id``); lines of others are left out before they are counted and weighed."""
    wanted = picklists.select(F.col("pick_list_id").alias("__wanted"))
    return line_totals(lines.join(wanted, F.col("pick_list_id") == F.col("__wanted"), "left_semi"), products, hot_items)


def with_line_totals(header: DataFrame, totals: DataFrame) -> DataFrame:
    """Header with its line totals; a header without lines has zeros."""
    zero = {"QtdSKU": "bigint", "QtdPecas": "decimal(18,2)", "PesoBruto": "decimal(18,4)"}
    joined = header.join(totals, "pick_list_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(kind)) for c, kind in zero.items()})


def with_date_key(df: DataFrame, calendar: DataFrame, date: str) -> DataFrame:
    """Add the calendar key; NULL outside the calendar."""
    days = calendar.select(F.col("data").alias("__day"), F.col("data_sk").alias("fk_data_sk"))
    return df.join(days, F.col(date) == F.col("__day"), "left").drop("__day")


def separation_seconds() -> Column:
    return F.unix_timestamp("pronto_conferencia") - F.unix_timestamp("em_separacao")


def fact_partitions(grain: str) -> dict[str, Column]:
    """Directory columns of the stored fact: the date key itself, or its month."""
    day = F.col("fk_data_sk")
    return {"fk_data_sk": day} if grain == "day" else {"month_sk": F.floor(day / 100).cast("int")}


# The columns of the fact's row hash, in order, and those that are not filled in it where NULL.
FACT_HASH = ["CodPickList", "fk_data_sk", "fk_empresa_sk", "fk_cliente_sk", "CodPedido", "DataPedido", "CodCliente", "Filial",
             "StatusDocumento", "QtdPecas", "QtdSKU", "ProntoParaImpressao", "EmSeparacao", "ProntoParaConferencia",
             "EmConferencia", "Conferido", "Saida", "CodTransp"]
FACT_HASH_UNFILLED = ("CodPickList", "fk_data_sk", "fk_empresa_sk", "fk_cliente_sk", "CodPedido", "CodCliente", "Filial",
                      "StatusDocumento", "QtdPecas", "QtdSKU")


def picklist_fact(header: DataFrame, lines: DataFrame, products: DataFrame, companies: DataFrame, customers: DataFrame,
                  calendar: DataFrame, updated_at: str, horizon: str = V.FACT_HORIZON,
                  hot: dict[str, dict] | None = None, totals: DataFrame | None = None) -> DataFrame:
    """One row per picklist from ``horizon`` on, with the branch and customer versions valid that day.

    Only four kinds of rows are shuffled: lines (reduced), headers once per lookup that is
    too big to broadcast, and the dimensions' narrow version columns. ``hot`` names hot
    customers, branches and items (``customer_id``, ``branch_id``, ``item_code``) to cut into pieces.
    Lines of picklists before the horizon are left out before they are counted and weighed.
    ``totals`` are ``wanted_totals`` of these picklists or more, where several facts share them.
    """
    hot = hot or {}
    recent = header.where(F.col("pick_date") >= F.lit(horizon).cast("date"))
    if totals is None:
        totals = wanted_totals(recent, lines, products, hot.get("item_code"))
    facts = with_line_totals(recent, totals)
    facts = asof_join(facts, companies, "branch_id", "cod_filial", "pick_date",
                      {"empresa_sk": "empresa_sk", "supervisor": "supervisor"}, hot.get("branch_id"), "pick_list_id")
    facts = asof_join(facts, customers, "customer_id", "customer_id", "pick_date",
                      {"customer_sk": "customer_sk"}, hot.get("customer_id"), "pick_list_id")
    facts = with_date_key(facts, calendar, "pick_date")

    c, nothing, rule = F.col, F.lit(None), F.lit(V.RULE_CONSIDER)
    shaped = facts.select(
        c("pick_list_id").alias("CodPickList"), c("pick_date").alias("DataPickList"),
        c("order_id").alias("CodPedido"), c("data_pedido").alias("DataPedido"),
        nothing.alias("NF"), nothing.alias("DataNota"), nothing.alias("DocNumNF"),
        F.lit(1).alias("Volume"), c("PesoBruto"), c("customer_id").alias("CodCliente"),
        F.lit(V.STOCK_TYPE).alias("TipoEstoque"), c("branch_id").alias("Filial"),
        c("QtdSKU"), c("QtdPecas"), F.lit(0).alias("QtdSN"),
        c("pronto_impressao").alias("ProntoParaImpressao"), c("pronto_impressao").alias("ProntoParaImpressaoAjustado"),
        c("em_separacao").alias("EmSeparacao"), c("pronto_conferencia").alias("ProntoParaConferencia"),
        c("em_conferencia").alias("EmConferencia"), c("conferido").alias("Conferido"), c("saida").alias("Saida"),
        # The extract names only the picker; the checker and dispatcher are taken to be the same.
        *[c("separator_id").alias(role) for role in
          ("IdSeparador", "UserSeparador", "IdConferente", "UserConferente", "IdExpedidor", "UserExpedidor")],
        nothing.alias("IdRomaneio"), nothing.alias("DataRomaneio"),
        F.when(c("status") == V.CANCELLED, "Y").otherwise("N").alias("Cancelado"), c("status").alias("StatusDocumento"),
        F.lit(V.FREIGHT_TYPE).alias("TipoFrete"), c("cod_transp").alias("CodTransp"), c("supervisor").alias("Supervisor"),
        rule.alias("Regra_PedidoFracionado"), rule.alias("Regra_SKU_SN"), rule.alias("Regra_Retira_NossoCarro"),
        separation_seconds().alias("sla_segundos"), nothing.alias("sla_HHMMSS"),
        F.lit(updated_at).alias("Atualizado"),
        c("fk_data_sk"), or_unknown("empresa_sk").alias("fk_empresa_sk"), or_unknown("customer_sk").alias("fk_cliente_sk"),
        nothing.alias("row_hash"),
    )
    typed = conform(shaped, "gold.fact_picklists")
    return typed.withColumn("row_hash", row_hash(typed, FACT_HASH, FACT_HASH_UNFILLED))


