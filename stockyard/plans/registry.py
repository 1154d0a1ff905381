"""Every operator as a query over the test tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard import fixed_values as V
from stockyard.functions import text
from stockyard.functions.calendar import calendar, calendar_spanning
from stockyard.functions.hashing import row_hash
from stockyard.functions.lookups import branch_size_of, cost_center_of, supervisor_of
from stockyard.operators import dedup, downtime, metrics, quality, scd2
from stockyard.operators.asof import asof_join, or_unknown
from stockyard.operators.keys import assign_surrogate_keys
from stockyard.operators.skew import find_hot, lookup
from stockyard.operators.upsert import changed_rows, upsert
from stockyard.plans import gold, refresh, sample_feed as feed, silver
from stockyard.schemas import RAW_COLUMNS, empty
from stockyard.session import together
from stockyard.sources import bronze, tables
from stockyard.sources.shared_dir import at_rest, shared_dir
from stockyard.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}

CALENDAR = ("1996-01-01", "2001-06-30")
SLA_TARGET = 18 * 60
BACKLOG_DAY = "2001-08-02"


def _query(run: Query) -> Query:
    _queries[run.__name__] = lambda spark, d: _comparable(run(spark, d))
    return run


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as text with all places of their scale, so that they compare exactly in every engine."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select([F.col(c).cast("string").alias(c) if isinstance(k, T.DecimalType) else F.col(c) for c, k in kinds.items()])


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- the tables the operators work on ------------------------------------------------------

def _header(spark, d):
    return silver.header(feed.opkl(spark, d))


def _lines(spark, d):
    return silver.lines(feed.opkl1(spark, d), F.col("ExtractTs"))


def _products(spark, d):
    return silver.products(feed.oitm(spark, d)).withColumnRenamed("product_id", "nk_product_id")


def _stored(spark, d, *steps):
    """Run load steps ``(table, build)`` on a fresh lake, storing each result; return the results."""
    lake, results = _scratch(spark, "lake"), []
    for table, build in steps:
        results.append(tables.publish(build(tables.read_table(spark, lake, table), *results[-1:]), lake, table))
    return results


def _customer_loads(spark, d):
    """Customer history after the first load and after the second."""
    def load(number, at):
        return lambda dim, *_: scd2.apply_changes(dim, silver.customers(feed.ocrd(spark, d, number)), "customer_id", "customer_sk", at)
    table = "silver.dim_cliente_scd"
    return _stored(spark, d, (table, load(1, feed.FIRST_LOAD)), (table, load(2, feed.SECOND_LOAD)))


def _branch_load(spark, d, number, at):
    return lambda dim, *_: scd2.apply_changes(dim, silver.branches(feed.owhs(spark, d, number), at), "branch_id", "branch_sk", at)


def _branch_loads(spark, d):
    table = "silver.dim_filial_scd"
    return _stored(spark, d, (table, _branch_load(spark, d, 1, feed.FIRST_LOAD)), (table, _branch_load(spark, d, 2, feed.SECOND_LOAD)))


def _company_loads(spark, d):
    """Enriched branch history after the first load and after the second."""
    def enrich(dim, branches):
        return gold.numbered_companies(dim, silver.companies(branches))
    branch, company = "silver.dim_filial_scd", "silver.dim_empresas"
    loads = _stored(spark, d, (branch, _branch_load(spark, d, 1, feed.FIRST_LOAD)), (company, enrich),
                    (branch, _branch_load(spark, d, 2, feed.SECOND_LOAD)), (company, enrich))
    return loads[1], loads[3]


def _hot_headers(spark, d):
    """Hot customers and branches, counted on the raw extract in a narrow scan."""
    return find_hot(feed.opkl(spark, d).select(F.col("U_CodCliente").alias("customer_id"), F.col("U_Filial").alias("branch_id")), ["customer_id", "branch_id"])


def _hot_items(spark, d):
    return find_hot(feed.opkl1(spark, d).select(F.col("ItemCode").alias("item_code")), ["item_code"])


def _hot(spark, d):
    """Hot customers, branches and items, and picklists with more than a task's share of the lines."""
    lines = feed.opkl1(spark, d).select(F.col("ItemCode").alias("item_code"), F.col("AbsEntry").alias("pick_list_id"))
    return {**_hot_headers(spark, d), **find_hot(lines, ["item_code", "pick_list_id"])}


def _line_totals(spark, d):
    return gold.line_totals(_lines(spark, d), _products(spark, d), _hot_items(spark, d)["item_code"])


def _dimensions(spark, d):
    """Company history, customer history and hot keys, built side by side."""
    companies, customers, hot = together(spark, lambda: _company_loads(spark, d)[1], lambda: _customer_loads(spark, d)[1], lambda: _hot(spark, d))
    return companies, customers, hot


def _dealt_lines(spark, d, hot):
    """Lines for the fact, dealt by picklist if none is hot."""
    return silver.lines(feed.opkl1(spark, d), F.col("ExtractTs"), by_picklist=not hot["pick_list_id"])


def _fact_and_lines(spark, d):
    companies, customers, hot = _dimensions(spark, d)
    lines = _dealt_lines(spark, d, hot)
    return gold.picklist_fact(
        _header(spark, d), lines, _products(spark, d), companies, customers,
        calendar(spark, *CALENDAR), feed.SECOND_LOAD, feed.HORIZON, hot), lines


def _fact(spark, d):
    return _fact_and_lines(spark, d)[0]


def _interval_history(spark, d):
    """A history with overlaps, gaps and bad ranges: each order as a version of its customer."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select(
        F.col("o_custkey").cast("string").alias("nk"), F.col("o_orderdate").alias("effective_start"),
        F.when(F.col("o_orderstatus") == "P", F.lit(V.OPEN_END).cast("timestamp_ntz"))
        .otherwise(F.expr("timestampadd(DAY, cast(o_totalprice as bigint) % 300, o_orderdate)")).alias("effective_end"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_current"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("row_hash"))


# --- scans, projections, parsing ---------------------------------------------------------

@_query
def scan_csv_bronze(spark, d):
    folder = _scratch(spark, "bronze")
    bronze.write_extract(feed.opkl(spark, d), "OPKL", f"{folder}/OPKL")
    return bronze.read_extract(spark, "OPKL", f"{folder}/OPKL")


@_query
def bronze_drops(spark, d):
    """Two drops of an extract by name pattern; the file of another extract beside them is not read."""
    root = _scratch(spark, "bronze")
    _two_header_drops(spark, d, root)
    bronze.write_extract(feed.oshp(spark, d), "OSHP", f"{root}/OPKL/OSHP_19980615_150000.csv")
    return bronze.read_bronze(spark, "OPKL", root)


@_query
def bronze_recent(spark, d):
    """Of two drops the one that a look-back of 35 days still opens."""
    root = _scratch(spark, "bronze")
    _two_header_drops(spark, d, root)
    return bronze.read_bronze(spark, "OPKL", root, since="1998-05-11 15:00:00")


def _two_header_drops(spark, d, root):
    raw, changed = feed.opkl(spark, d), F.col("UpdateDate")
    bronze.write_drop(raw.where(changed < feed.SECOND_LOAD), "OPKL", root, _stamp(feed.FIRST_LOAD))
    bronze.write_drop(raw.where(changed >= feed.SECOND_LOAD), "OPKL", root, _stamp(feed.SECOND_LOAD))


def _stamp(at: str) -> str:
    return at.replace("-", "").replace(":", "").replace(" ", "_")


@_query
def operator_dim(spark, d):
    return silver.operators(feed.ousr(spark, d))


@_query
def carrier_dim(spark, d):
    return silver.carriers(feed.oshp(spark, d))


@_query
def stage_header(spark, d):
    return silver.stage_header(feed.opkl(spark, d))


@_query
def parse_dates(spark, d):
    raw = feed.opkl(spark, d)
    return raw.select("AbsEntry", "UpdateDate",
                      text.parse_ts_or_date(F.col("PickDate")).alias("pick_ts"),
                      text.parse_ts_or_date(F.col("PickDate"), V.BRAZILIAN_TIMESTAMP_FORMAT).alias("pick_ts_any"),
                      text.parse_ts(F.col("U_DataPedido")).alias("ordered_at"))


@_query
def clean_text(spark, d):
    return feed.ocrd(spark, d, 2).select(F.col("CardCode").alias("customer_id"), F.col("UpdateDate").alias("update_text"),
                                         text.clean_text(F.col("State1")).alias("state"), F.lower("E_Mail").alias("email"))


@_query
def repair_decimal(spark, d):
    return silver.stage_lines(feed.opkl1(spark, d), F.col("ExtractTs")).select(
        "pick_list_id", "pick_line_id", "updated_at", "rel_quantity", "pick_quantity")


@_query
def extract_code(spark, d):
    return feed.opkl(spark, d).select("AbsEntry", "UpdateDate", text.extract_code(F.col("U_Filial")).alias("branch_code"),
                                      text.extract_code(F.col("Status")).alias("no_digits"))


@_query
def quarantine_report(spark, d):
    rejects = silver.header_rejects(feed.opkl(spark, d))
    rescued = text.parse_ts_or_date(F.col("PickDate"), V.BRAZILIAN_TIMESTAMP_FORMAT).isNotNull()
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("rejected"), F.count_if(rescued).alias("rescued_by_extra_format"))


@_query
def malformed_lines(spark, d):
    """Headers dropped as text of which some lines lack two fields and some have one more: those with their number of fields, the others as rows."""
    root, columns, k = _scratch(spark, "bronze"), RAW_COLUMNS["OPKL"].split(), F.col("AbsEntry").cast("bigint")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    line = (F.when(k % 50 == 9, F.concat_ws(";", *fields[:-2])).when(k % 50 == 19, F.concat_ws(";", *fields, F.lit("extra")))
            .otherwise(F.concat_ws(";", *fields)))
    # One column whose name is the extract's head line, written as it is.
    feed.opkl(spark, d).select(line.alias(";".join(columns))).write.options(sep="\u0001", quote="", header="true").csv(f"{root}/OPKL/OPKL_{_stamp(feed.FIRST_LOAD)}.csv")
    checked = bronze.read_checked(spark, "OPKL", root)
    bad = bronze.malformed_rows(checked).select(F.substring_index("line", ";", 1).alias("AbsEntry"), "fields", "line")
    good = bronze.well_formed(checked).select("AbsEntry", F.lit(len(columns)).cast("bigint").alias("fields"), F.lit(None).cast("string").alias("line"))
    return bad.unionByName(good)


# --- deduplication and hashing ---------------------------------------------------------------

@_query
def dedup_latest_header(spark, d):
    return silver.latest_header(silver.stage_header(feed.opkl(spark, d)))


@_query
def dedup_latest_line(spark, d):
    return silver.latest_lines(silver.stage_lines(feed.opkl1(spark, d), F.col("ExtractTs")))


@_query
def dedup_latest_customer(spark, d):
    return silver.latest_customers(silver.stage_customers(feed.ocrd(spark, d, 2)))


@_query
def dedup_latest_product(spark, d):
    return silver.latest_products(silver.stage_products(feed.oitm(spark, d)))


@_query
def row_hash_header(spark, d):
    return _header(spark, d).select("pick_list_id", "row_hash")


@_query
def row_hash_line(spark, d):
    return _lines(spark, d).select("pick_list_id", "pick_line_id", "row_hash")


@_query
def row_hash_product(spark, d):
    return _products(spark, d).select("nk_product_id", "row_hash")


@_query
def row_hash_versioned(spark, d):
    history = _customer_loads(spark, d)[1]
    hashed = row_hash(history, silver.CUSTOMER_HASH + gold.VALIDITY)
    return history.select("customer_id", "effective_start", hashed.alias("row_hash"))


# --- calendar -----------------------------------------------------------------------------------

@_query
def calendar_dim(spark, d):
    return calendar_spanning(spark.read.parquet(f"{d}/orders.parquet"), "o_orderdate")


@_query
def calendar_join(spark, d):
    header = silver.latest_header(silver.stage_header(feed.opkl(spark, d)))
    return gold.with_date_key(header.select("pick_list_id", "pick_date"), calendar(spark, *CALENDAR), "pick_date")


# --- lines and header ---------------------------------------------------------------------------

@_query
def line_weight(spark, d):
    return _line_totals(spark, d).select("pick_list_id", "PesoBruto")


@_query
def lines_per_picklist(spark, d):
    return _line_totals(spark, d).select("pick_list_id", "QtdSKU", "QtdPecas")


@_query
def header_with_lines(spark, d):
    header = _header(spark, d).select("pick_list_id", "pick_date", "status")
    return gold.with_line_totals(header, _line_totals(spark, d))


@_query
def sla_seconds(spark, d):
    return _header(spark, d).select("pick_list_id", gold.separation_seconds().alias("sla_segundos"))


# --- upserts and keys --------------------------------------------------------------------------

def _customer_snapshot(spark, d, load):
    return silver.customers(feed.ocrd(spark, d, load)).withColumnRenamed("source_hash", "row_hash")


@_query
def changed_customers(spark, d):
    return changed_rows(_customer_snapshot(spark, d, 1), _customer_snapshot(spark, d, 2), ["customer_id"])


@_query
def upsert_hash_guarded(spark, d):
    return upsert(_customer_snapshot(spark, d, 1), _customer_snapshot(spark, d, 2), ["customer_id"])


@_query
def upsert_composite_key(spark, d):
    raw = feed.opkl1(spark, d)
    stored = silver.lines(raw.where(F.col("ExtractTs") < feed.SECOND_LOAD), F.col("ExtractTs"))
    source = silver.lines(raw.where(F.col("ExtractTs") >= feed.HORIZON), F.col("ExtractTs"))
    return upsert(stored, source, ["pick_list_id", "pick_line_id"], source_unique=True)


@_query
def upsert_insert_only(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    before = orders.where(F.col("o_orderdate") < F.lit(feed.SECOND_LOAD).cast("timestamp_ntz"))
    stored = calendar_spanning(before, "o_orderdate").withColumn("nome_dia", F.lit("stored"))
    return upsert(stored, calendar_spanning(orders, "o_orderdate"), ["data_sk"], guard="insert_only")


@_query
def upsert_unconditional(spark, d):
    first, second = _company_loads(spark, d)
    return gold.current_companies(gold.current_companies(empty(spark, "gold.dim_empresas"), first), second)


@_query
def surrogate_keys(spark, d):
    latest = silver.latest_customers(silver.stage_customers(feed.ocrd(spark, d, 2)))
    return assign_surrogate_keys(latest.select("customer_id", "customer_name"), "customer_sk", ["customer_id"], above=1000)


@_query
def unknown_member(spark, d):
    return gold.product_dimension(empty(spark, "gold.dim_produto"), silver.products(feed.oitm(spark, d)))


def _merged_header(spark, lake, source):
    (part, value), = silver.header_partition().items()
    return tables.merge_touched(source, lake, "silver.opkl_clean", ["pick_list_id"], part, value)


@_query
def merge_moved_partition(spark, d):
    """Cancelled picklists get a date 40 days later, so that their rows leave a month and enter another."""
    lake, header = _scratch(spark, "lake"), _header(spark, d)
    _merged_header(spark, lake, header)
    later = header.where(F.col("status") == V.CANCELLED).withColumn("pick_date", F.date_add("pick_date", 40))
    return _merged_header(spark, lake, later.withColumn("row_hash", row_hash(later, silver.HEADER_HASH)))


@_query
def merge_after_publish(spark, d):
    """Headers published as a whole after the first drop, then merged by month with all rows."""
    lake, raw = _scratch(spark, "lake"), feed.opkl(spark, d)
    tables.publish(silver.header(raw.where(F.col("UpdateDate") < feed.SECOND_LOAD)), lake, "silver.opkl_clean")
    return _merged_header(spark, lake, silver.header(raw))


# --- history -----------------------------------------------------------------------------------

@_query
def scd2_customer(spark, d):
    return _customer_loads(spark, d)[1]


@_query
def scd2_branch(spark, d):
    return _branch_loads(spark, d)[1]


@_query
def scd2_late_reject(spark, d):
    """The first load again after the second: its changed rows are late and left out."""
    late = silver.customers(feed.ocrd(spark, d, 1))
    return scd2.apply_changes(_customer_loads(spark, d)[1], late, "customer_id", "customer_sk", feed.SECOND_LOAD, late="reject")


@_query
def current_dimension(spark, d):
    first, second = _customer_loads(spark, d)
    return gold.current_customers(gold.current_customers(empty(spark, "gold.dim_cliente"), first), second)


@_query
def current_branch_dimension(spark, d):
    first, second = _branch_loads(spark, d)
    return gold.current_branches(gold.current_branches(empty(spark, "gold.dim_filial"), first), second)


@_query
def sync_history(spark, d):
    first, second = _customer_loads(spark, d)
    return scd2.sync_history(scd2.sync_history(empty(spark, "gold.dim_cliente_scd"), first, "customer_sk"), second, "customer_sk")


@_query
def sync_history_hash_only(spark, d):
    first, second = _branch_loads(spark, d)
    copy = scd2.sync_history(empty(spark, "gold.dim_filial_scd"), first, "branch_sk", propagate_closure=False)
    return scd2.sync_history(copy, second, "branch_sk", propagate_closure=False)


# --- branches -----------------------------------------------------------------------------------

@_query
def map_supervisor(spark, d):
    return silver.stage_customers(feed.ocrd(spark, d, 2)).select("customer_id", "src_ts", "state", supervisor_of(F.col("state")).alias("supervisor"))


@_query
def map_cost_center(spark, d):
    code = text.extract_code(F.col("branch_id"))
    return _header(spark, d).select("pick_list_id", cost_center_of(code).alias("centro_de_custo"))


@_query
def map_branch_size(spark, d):
    code = text.extract_code(F.col("branch_id"))
    return _header(spark, d).select("pick_list_id", branch_size_of(code).alias("porte"))


@_query
def branch_enrichment(spark, d):
    return _company_loads(spark, d)[1]


@_query
def branch_hours(spark, d):
    return gold.opening_hours_dimension(silver.opening_hours(_company_loads(spark, d)[1]))


@_query
def full_refresh(spark, d):
    lake = _scratch(spark, "lake")
    for companies in _company_loads(spark, d):
        stored = tables.publish(silver.opening_hours(companies), lake, "silver.dim_filiais_horarios")
    return stored


# --- point-in-time joins and the fact -----------------------------------------------------------

@_query
def asof_customer_sk(spark, d):
    header = silver.latest_header(silver.stage_header(feed.opkl(spark, d))).select("pick_list_id", "customer_id", "pick_date")
    joined = asof_join(header, _customer_loads(spark, d)[1], "customer_id", "customer_id", "pick_date", {"customer_sk": "sk"},
                       _hot_headers(spark, d)["customer_id"], "pick_list_id")
    return joined.select("pick_list_id", "pick_date", or_unknown("sk").alias("customer_sk"))


@_query
def asof_branch_sk(spark, d):
    header = silver.latest_header(silver.stage_header(feed.opkl(spark, d))).select("pick_list_id", "branch_id", "pick_date")
    joined = asof_join(header, _company_loads(spark, d)[1], "branch_id", "cod_filial", "pick_date",
                       {"empresa_sk": "sk", "supervisor": "supervisor"}, _hot_headers(spark, d)["branch_id"], "pick_list_id")
    return joined.select("pick_list_id", "pick_date", or_unknown("sk").alias("empresa_sk"), "supervisor")


@_query
def skewed_lookup(spark, d):
    """Orders and the number of orders of their status: two keys hold nearly all rows, the third is NULL."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    left = orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    sizes = orders.groupBy(F.col("o_orderstatus").alias("of")).agg(F.count("*").alias("orders_of_status"))
    found = lookup(left, sizes, "status", "of", hot=find_hot(left, ["status"])["status"], spread="o_orderkey")
    return found.select("o_orderkey", "status", "orders_of_status")


@_query
def skewed_asof(spark, d):
    """Lines and the yearly version of their return flag: every key holds many rows and several versions."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("line"), F.col("l_returnflag").alias("flag"), F.col("l_shipdate").cast("date").alias("day"))
    start = F.make_date(F.year("day"), F.lit(1), F.lit(1))
    versions = lines.groupBy(F.col("flag").alias("of"), start.alias("from")).agg(F.count("*").alias("lines")).select(
        "of", F.col("from").cast("timestamp_ntz").alias("effective_start"), F.add_months("from", 12).cast("timestamp_ntz").alias("effective_end"), "lines")
    found = asof_join(lines, versions, "flag", "of", "day", {"lines": "lines_of_year"}, find_hot(lines, ["flag"])["flag"], "line")
    return found.groupBy("flag", "lines_of_year").agg(F.count("*").alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@_query
def fact_picklists(spark, d):
    return _fact(spark, d)


@_query
def fact_upsert(spark, d):
    """The fact from first versions only, then brought up to date."""
    raw, days = feed.opkl(spark, d), calendar(spark, *CALENDAR)
    companies, customers, hot = _dimensions(spark, d)
    lines, products = _dealt_lines(spark, d, hot), _products(spark, d)
    # Totals once for both facts: of every picklist of which any version is recent.
    recent = silver.stage_header(raw).where(F.col("pick_ts").cast("date") >= F.lit(feed.HORIZON).cast("date"))
    totals = at_rest(gold.wanted_totals(recent, lines, products, hot["item_code"]))

    def built(header, at):
        return gold.picklist_fact(header, lines, products, companies, customers, days, at, feed.HORIZON, hot, totals)

    stored = built(silver.header(raw.where(F.col("UpdateDate") < feed.SECOND_LOAD)), feed.FIRST_LOAD)
    return upsert(stored, built(silver.header(raw), feed.SECOND_LOAD), ["CodPickList"], source_unique=True)


@_query
def refresh_window(spark, d):
    """The fact after a load of everything and a second one that opens the newest drop only and builds only what it changed."""
    root, lake = _scratch(spark, "bronze"), _scratch(spark, "lake")

    def load(at, window, headers, lines, number):
        bronze.write_drop(feed.opkl(spark, d).where(headers), "OPKL", root, _stamp(at))
        bronze.write_drop(feed.opkl1(spark, d).where(lines), "OPKL1", root, _stamp(at))
        bronze.write_drop(feed.ocrd(spark, d, number), "OCRD", root, _stamp(at))
        bronze.write_drop(feed.owhs(spark, d, number), "OWHS", root, _stamp(at))
        bronze.write_drop(feed.oitm(spark, d), "OITM", root, _stamp(at))
        refresh.refresh(spark, root, lake, at, feed.HORIZON, CALENDAR, partition="month", window=window)

    changed, extracted = F.col("UpdateDate"), F.col("ExtractTs")
    load(feed.FIRST_LOAD, None, changed < feed.SECOND_LOAD, extracted < feed.SECOND_LOAD, 1)
    load(feed.SECOND_LOAD, V.INCREMENTAL_WINDOW_DAYS, changed >= feed.SECOND_LOAD, extracted >= feed.SECOND_LOAD, 2)
    return tables.read_table(spark, lake, "gold.fact_picklists").select(
        "CodPickList", "fk_data_sk", "fk_empresa_sk", "fk_cliente_sk", "StatusDocumento", "QtdSKU", "QtdPecas", "row_hash")


@_query
def fact_partition_counts(spark, d):
    stored = tables.publish(_fact(spark, d), _scratch(spark, "lake"), "gold.fact_picklists", gold.fact_partitions("month"))
    return stored.groupBy("fk_data_sk").agg(F.count("*").alias("picklists"), F.sum("QtdPecas").alias("pieces"))


# --- quality ---------------------------------------------------------------------------------

@_query
def dq_duplicates(spark, d):
    return dedup.repeated_keys(silver.stage_lines(feed.opkl1(spark, d), F.col("ExtractTs")), ["pick_list_id", "pick_line_id"])


@_query
def dq_header(spark, d):
    return quality.header_checks(_header(spark, d))


@_query
def dq_header_raw(spark, d):
    """The header checks before deduplication, where they must fire."""
    staged = silver.stage_header(feed.opkl(spark, d))
    return quality.header_checks(staged.select("pick_list_id", F.col("pick_ts").cast("date").alias("pick_date"), "data_pedido",
                                               F.col("customer_id").alias("row_hash")))


@_query
def dq_fact(spark, d):
    return quality.fact_checks(_fact(spark, d))


@_query
def dq_scd_customer(spark, d):
    return quality.history_checks(_customer_loads(spark, d)[1], "customer_id", "silver.dim_cliente_scd", quality.CUSTOMER_CHECKS)


@_query
def dq_scd_branch(spark, d):
    return quality.history_checks(_company_loads(spark, d)[1], "cod_filial", "silver.dim_empresas", quality.BRANCH_CHECKS)


@_query
def dq_scd_late(spark, d):
    """The first load again after the second, accepted: bad ranges and overlaps must be found."""
    late = silver.customers(feed.ocrd(spark, d, 1))
    history = scd2.apply_changes(_customer_loads(spark, d)[1], late, "customer_id", "customer_sk", feed.SECOND_LOAD)
    return quality.history_checks(history, "customer_id", "silver.dim_cliente_scd", quality.CUSTOMER_CHECKS)


@_query
def dq_scd_overlap(spark, d):
    return quality.history_counts(_interval_history(spark, d), "nk").select("scd_overlap", "scd_bad_range", "scd_multi_curr")


@_query
def dq_scd_gap(spark, d):
    return quality.history_counts(_interval_history(spark, d), "nk").select("scd_gap", "scd_missing_hash", "scd_curr_bad_end")


@_query
def dq_report(spark, d):
    header = _header(spark, d)
    companies, customers, hot = _dimensions(spark, d)
    fact = gold.picklist_fact(header, _dealt_lines(spark, d, hot), _products(spark, d), companies, customers,
                              calendar(spark, *CALENDAR), feed.SECOND_LOAD, feed.HORIZON, hot)
    return quality.quality_report(fact, customers, companies, header)


@_query
def dq_totals(spark, d):
    return quality.total_violations(dq_report(spark, d))


# --- service metrics -------------------------------------------------------------------------

@_query
def sla_by_branch(spark, d):
    return metrics.separation_times(_fact(spark, d), ["Filial"])


@_query
def sla_by_day(spark, d):
    return metrics.separation_times(_fact(spark, d), ["DataPickList"])


@_query
def sla_rollup(spark, d):
    """Quantiles of months and branches from bins stored by branch and day."""
    bins = tables.publish(metrics.separation_bins(_fact(spark, d)), _scratch(spark, "lake"), "gold.separation_bins")
    return metrics.separation_rollup(bins)


@_query
def sla_breach_rate(spark, d):
    return metrics.breach_rate(_fact(spark, d), SLA_TARGET, ["Supervisor"])


@_query
def operator_productivity(spark, d):
    return metrics.operator_productivity(*_fact_and_lines(spark, d))


@_query
def backlog(spark, d):
    return metrics.backlog(_fact(spark, d), BACKLOG_DAY)


@_query
def downtime_by_reason(spark, d):
    return downtime.downtime_by_reason(downtime.stage_downtime(feed.downtime(spark, d)))


@_query
def downtime_intervals(spark, d):
    return downtime.branch_stops(downtime.stage_downtime(feed.downtime(spark, d)))


@_query
def exclude_downtime(spark, d):
    # Stored first: the fact is read twice, once narrow for the overlap and once for the result.
    fact = tables.publish(_fact(spark, d), _scratch(spark, "lake"), "gold.fact_picklists")
    kept = downtime.exclude_downtime(fact, downtime.stage_downtime(feed.downtime(spark, d)))
    return kept.select("CodPickList", "Filial", "sla_segundos")


# --- incremental loading --------------------------------------------------------------------------

@_query
def incremental_window(spark, d):
    staged = silver.stage_header(feed.opkl(spark, d))
    return incremental.incremental_window(staged, "update_date", feed.SECOND_LOAD).select("pick_list_id", "status", "update_date")


def _streamed(spark, d, *drops, ranking=None):
    """Header table after the drops of the extract went through the stream one by one."""
    raw, bronze_root, lake = feed.opkl(spark, d), _scratch(spark, "bronze"), _scratch(spark, "lake")
    for drop in (raw.where(which) for which in drops):
        bronze.write_extract(drop, "OPKL", f"{bronze_root}/OPKL")
        stream = bronze.stream_bronze(spark, "OPKL", bronze_root, pattern="*.csv")
        incremental.upsert_stream(stream, silver.header, lake, "silver.opkl_clean", ["pick_list_id"], f"{lake}/_stream",
                                  silver.header_partition(), ranking)
    return tables.read_table(spark, lake, "silver.opkl_clean")


@_query
def stream_upsert_header(spark, d):
    """Two file drops through the stream, in the order they were extracted; must equal one batch."""
    changed = F.col("UpdateDate")
    return _streamed(spark, d, changed < feed.SECOND_LOAD, changed >= feed.SECOND_LOAD)


@_query
def stream_late_files(spark, d):
    """The newer drop first, the older one late; must equal one batch."""
    changed = F.col("UpdateDate")
    return _streamed(spark, d, changed >= feed.SECOND_LOAD, changed < feed.SECOND_LOAD, ranking=silver.header_ranking())


@_query
def stream_keyed_state(spark, d):
    """The newer drop first, the older one late, after a restart from the checkpoint; ranks are kept as state. Must equal one batch."""
    raw, root, lake = feed.opkl(spark, d), _scratch(spark, "bronze"), _scratch(spark, "lake")
    changed = F.col("UpdateDate")
    for drop in (changed >= feed.SECOND_LOAD, changed < feed.SECOND_LOAD):
        bronze.write_extract(raw.where(drop), "OPKL", f"{root}/OPKL")
        stream = bronze.stream_bronze(spark, "OPKL", root, pattern="*.csv")
        incremental.rank_stream(stream, lake, "silver.opkl_clean", ["pick_list_id"], f"{lake}/_stream", silver.header_partition(), silver.header_ranking())
    return tables.read_table(spark, lake, "silver.opkl_clean")


def queries() -> dict[str, Query]:
    return dict(_queries)
