"""Silver: raw text to typed, deduplicated, hashed rows; customer and branch history."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.functions.hashing import row_hash
from stockyard.functions.lookups import branch_size_of, cost_center_of, supervisor_of
from stockyard.functions.text import clean_text, extract_code, parse_ts, parse_ts_or_date, repair_decimal
from stockyard.operators.dedup import Ranking, keep_latest

# The columns of each row hash, in order.
HEADER_HASH = ["pick_date", "status", "order_id", "data_pedido", "customer_id", "branch_id", "separator_id",
               "pronto_impressao", "em_separacao", "pronto_conferencia", "em_conferencia", "conferido", "saida", "cod_transp"]
LINE_HASH = ["order_id", "item_code", "rel_quantity", "pick_quantity"]
PRODUCT_HASH = ["product_name", "category_id", "sales_unit", "buy_unit", "weight", "length", "width", "height", "barcode", "is_active"]
CUSTOMER_HASH = ["customer_name", "tax_id", "email", "state", "city", "zip_code", "address", "phone", "is_active"]
BRANCH_HASH = ["branch_name", "state", "city", "zip_code", "street"]


def _text(columns: dict[str, str]) -> list[Column]:
    return [F.col(raw).alias(name) for name, raw in columns.items()]


def _time(load_ts: str | Column) -> Column:
    return (load_ts if isinstance(load_ts, Column) else F.lit(load_ts)).cast("timestamp_ntz")


# --- picklist header ---------------------------------------------------------------------

def stage_header(raw: DataFrame, *extra_formats: str) -> DataFrame:
    """Typed header rows with a key. ``extra_formats`` are further timestamp texts to accept."""
    formats = (V.TIMESTAMP_FORMAT, *extra_formats)
    stages = {"pronto_impressao": "U_ProntoParaImpressao", "em_separacao": "U_EmSeparacao",
              "pronto_conferencia": "U_ProntoParaConferencia", "em_conferencia": "U_EmConferencia",
              "conferido": "U_Conferido", "saida": "U_Saida"}
    return raw.where(F.col("AbsEntry").isNotNull()).select(
        F.col("AbsEntry").alias("pick_list_id"),
        parse_ts_or_date(F.col("PickDate"), *extra_formats).alias("pick_ts"),
        clean_text(F.col("Status")).alias("status"),
        F.col("U_CodPedido").alias("order_id"),
        parse_ts(F.col("U_DataPedido"), *formats).alias("data_pedido"),
        *_text({"customer_id": "U_CodCliente", "branch_id": "U_Filial", "separator_id": "U_IdSeparador"}),
        *[parse_ts(F.col(raw_name), *formats).alias(name) for name, raw_name in stages.items()],
        F.col("U_CodTransp").alias("cod_transp"),
        parse_ts(F.col("UpdateDate"), *formats).alias("update_date"),
    )


HEADER_RANK = ["update_date", "pick_ts"]
# The staged columns that the header table stores as they are.
HEADER_KEPT = ["status", "order_id", "data_pedido", "customer_id", "branch_id", "separator_id", "pronto_impressao",
               "em_separacao", "pronto_conferencia", "em_conferencia", "conferido", "saida", "cod_transp"]


def header_versions(staged: DataFrame) -> DataFrame:
    """Latest staged row per picklist among rows with a readable date."""
    return keep_latest(staged.where(F.col("pick_ts").isNotNull()), ["pick_list_id"], HEADER_RANK)


def _header_rows(latest: DataFrame) -> DataFrame:
    return latest.select("pick_list_id", F.col("pick_ts").cast("date").alias("pick_date"), *HEADER_KEPT, F.col("pick_ts").alias("created_at"))


def _hashed_header(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row_hash", row_hash(rows, HEADER_HASH))


def latest_header(staged: DataFrame) -> DataFrame:
    """Latest version per picklist among rows with a readable date, in the table's columns."""
    return _header_rows(header_versions(staged))


def header(raw: DataFrame, *extra_formats: str) -> DataFrame:
    return _hashed_header(latest_header(stage_header(raw, *extra_formats)))


def header_ranking() -> Ranking:
    """Headers of several files: the latest change counts, whatever the order of the files."""
    return Ranking("silver.opkl_versions", line_partition(), HEADER_RANK, ["update_date"],
                   stage=lambda raw: header_versions(stage_header(raw)),
                   restage=lambda stored: stored.select("pick_list_id", F.col("created_at").alias("pick_ts"), *HEADER_KEPT, "update_date"),
                   finish=lambda latest: _hashed_header(_header_rows(latest)),
                   rows=lambda raw: stage_header(raw).where(F.col("pick_ts").isNotNull()))


def header_rejects(raw: DataFrame, *extra_formats: str) -> DataFrame:
    """Raw header rows that ``header`` leaves out unread, with the reason."""
    date = parse_ts_or_date(F.col("PickDate"), *extra_formats)
    reason = F.when(F.col("AbsEntry").isNull(), "missing key").when(date.isNull(), "unreadable date")
    return raw.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


# --- picklist lines ------------------------------------------------------------------------

def stage_lines(raw: DataFrame, updated_at: str | Column, strict: bool = False) -> DataFrame:
    """Typed line rows with both keys; ``updated_at`` is the load time or an extract-time column."""
    return raw.where(F.col("AbsEntry").isNotNull() & F.col("PickEntry").isNotNull()).select(
        *_text({"pick_list_id": "AbsEntry", "pick_line_id": "PickEntry", "order_id": "OrderEntry", "item_code": "ItemCode"}),
        repair_decimal(F.col("RelQtty"), 18, 2, strict).alias("rel_quantity"),
        repair_decimal(F.col("PickQtty"), 18, 2, strict).alias("pick_quantity"),
        _time(updated_at).alias("updated_at"),
    )


def latest_lines(staged: DataFrame) -> DataFrame:
    return keep_latest(staged, ["pick_list_id", "pick_line_id"], ["updated_at"])


def lines(raw: DataFrame, updated_at: str | Column, strict: bool = False, by_picklist: bool = False) -> DataFrame:
    """Latest version per line. ``by_picklist`` deals the rows by picklist, once for this step and those that follow on picklists; not for rows of which
    a picklist holds more than a task's share."""
    staged = stage_lines(raw, updated_at, strict)
    latest = latest_lines(staged.repartition("pick_list_id") if by_picklist else staged)
    return latest.withColumn("row_hash", row_hash(latest, LINE_HASH))


def header_partition() -> dict[str, Column]:
    """Month of the picklist: a load mostly touches recent months."""
    return {"pick_month": (F.year("pick_date") * 100 + F.month("pick_date")).cast("int")}


def line_partition(ids: int = 1_000_000, others: int = 1024) -> dict[str, Column]:
    """Range of picklist ids, which the source numbers in sequence; other ids are dealt over ``others`` partitions below zero."""
    numbered = F.floor(F.col("pick_list_id").try_cast("bigint") / ids).cast("bigint")
    return {"id_range": F.coalesce(numbered, -1 - F.pmod(F.xxhash64("pick_list_id"), F.lit(others)))}


# --- products --------------------------------------------------------------------------------

def stage_products(raw: DataFrame, strict: bool = False) -> DataFrame:
    return raw.where(F.col("ItemCode").isNotNull()).select(
        *_text({"product_id": "ItemCode", "product_name": "ItemName", "category_id": "ItmsGrpCod",
                "sales_unit": "SalUnitMsr", "buy_unit": "BuyUnitMsr"}),
        repair_decimal(F.col("SWeight1"), 18, 3, strict).alias("weight"),
        repair_decimal(F.col("SLength1"), 18, 2, strict).alias("length"),
        repair_decimal(F.col("SWidth1"), 18, 2, strict).alias("width"),
        repair_decimal(F.col("SHeight1"), 18, 2, strict).alias("height"),
        *_text({"barcode": "CodeBars", "is_active": "validFor"}),
        parse_ts_or_date(F.col("CreateDate")).alias("created_at"),
    )


def latest_products(staged: DataFrame) -> DataFrame:
    return keep_latest(staged, ["product_id"], ["created_at"])


def products(raw: DataFrame, strict: bool = False) -> DataFrame:
    latest = latest_products(stage_products(raw, strict))
    return latest.withColumn("row_hash", row_hash(latest, PRODUCT_HASH))


# --- customers ---------------------------------------------------------------------------------

def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("CardCode").isNotNull()).select(
        *_text({"customer_id": "CardCode", "customer_name": "CardName", "tax_id": "LicTradNum"}),
        F.lower("E_Mail").alias("email"),
        clean_text(F.col("State1")).alias("state"),
        *_text({"city": "City", "zip_code": "ZipCode", "address": "Address", "phone": "Phone1", "is_active": "validFor"}),
        F.coalesce(parse_ts(F.col("UpdateDate")), parse_ts(F.col("CreateDate"))).alias("src_ts"),
    )


def latest_customers(staged: DataFrame) -> DataFrame:
    return keep_latest(staged, ["customer_id"], ["src_ts", "customer_name"])


def customers(raw: DataFrame) -> DataFrame:
    """One snapshot of customers, ready for ``apply_changes``."""
    latest = latest_customers(stage_customers(raw))
    return latest.withColumn("source_hash", row_hash(latest, CUSTOMER_HASH))


# --- branches -------------------------------------------------------------------------------------

def branches(raw: DataFrame, load_ts: str | Column) -> DataFrame:
    """One snapshot of branches; the extract has no change date, so the load time stands in."""
    staged = raw.where(F.col("WhsCode").isNotNull()).select(
        *_text({"branch_id": "WhsCode", "branch_name": "WhsName"}),
        clean_text(F.col("State")).alias("state"),
        *_text({"city": "City", "zip_code": "ZipCode", "street": "Street"}),
        _time(load_ts).alias("src_ts"),
    )
    latest = keep_latest(staged, ["branch_id"], ["src_ts"])
    return latest.withColumn("source_hash", row_hash(latest, BRANCH_HASH))


def companies(branch_history: DataFrame) -> DataFrame:
    """Branch versions with code, supervisor, cost centre and size; validity is kept."""
    coded = branch_history.where(F.col("branch_id") != V.UNKNOWN_KEY).withColumn("codigo", extract_code(F.col("branch_id")))
    code = F.col("codigo")
    return coded.select(
        code, F.col("branch_name").alias("nome"), code.alias("empresa_estoque"), F.col("branch_id").alias("cod_filial"),
        F.col("branch_name").alias("razao_social"), F.col("state").alias("uf"), F.col("city").alias("cidade"),
        F.lit("").alias("bairro"), F.col("street").alias("endereco"), F.col("zip_code").alias("cep"),
        supervisor_of(F.col("state")).alias("supervisor"), cost_center_of(code).alias("centro_de_custo"),
        branch_size_of(code).alias("porte"), "is_current", "effective_start", "effective_end",
    )


def opening_hours(company_history: DataFrame) -> DataFrame:
    """Opening hours of each current branch; only small branches close for lunch."""
    current = company_history.where(F.col("is_current") & (F.col("cod_filial") != V.UNKNOWN_KEY))
    clocks = [F.lit(t).cast("timestamp_ntz").alias(name) for name, t in V.OPENING_HOURS.items()]
    return current.select("cod_filial", F.col("nome").alias("filial"), *clocks,
                          F.coalesce(F.col("porte") == V.SMALL, F.lit(False)).alias("pausa_para_almoco"), "supervisor")


# --- operators and carriers --------------------------------------------------------------------------

def operators(raw: DataFrame) -> DataFrame:
    staged = raw.where(F.col("USER_CODE").isNotNull()).select(
        *_text({"user_code": "USER_CODE", "user_name": "U_NAME", "department": "Department", "region": "Branch"}))
    latest = keep_latest(staged, ["user_code"])
    return latest.withColumn("row_hash", row_hash(latest, ["user_name", "department", "region"]))


def carriers(raw: DataFrame) -> DataFrame:
    staged = raw.where(F.col("TrnspCode").isNotNull()).select(
        *_text({"carrier_code": "TrnspCode", "carrier_name": "TrnspName", "website": "WebSite"}))
    latest = keep_latest(staged, ["carrier_code"])
    return latest.withColumn("row_hash", row_hash(latest, ["carrier_name", "website"]))
