"""Raw extracts derived from the test tables, so that every operator starts from dirty text.

Every row of the source tables takes part; column arithmetic only decides what a row looks
like. `registry` runs the operators on these extracts and `oracle` restates both in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.functions.lookups import name_at

FIRST_LOAD = "1995-01-01 00:00:00"
SECOND_LOAD = "1998-06-15 15:00:00"
HORIZON = "1996-01-01"
STATES = ["AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
          "EX", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO"]

_TS, _DAY, _BR = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm:ss"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _code(prefix: str, n: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))


def _state(n: Column) -> Column:
    return name_at(STATES, (n % len(STATES)).cast("int") + 1)


def opkl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers from orders; urgent orders also carry the version extracted before they finished."""
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    twice = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                 F.expr("timestampadd(MINUTE, 480 + o_orderkey % 480, o_orderdate)").alias("placed"), F.explode(twice).alias("v"))
    done = (F.col("o_orderstatus") == "F") & (F.col("v") == 1)
    start = 4 + k % 13
    ready = start + F.when(k % 997 == 5, -5).otherwise(13 + k % 15)
    checking = ready + 1 + k % 4
    checked = checking + 2 + k % 6
    left = checked + 60 * (1 + k % 3)

    def stage(minutes: Column) -> Column:
        return F.when(done, F.date_format(F.timestamp_add("MINUTE", minutes, F.col("placed")), _TS))

    letter = F.when(done, "E").when((F.col("o_orderstatus") == "P") & (F.col("v") == 1), "C").otherwise("P")
    placed = F.date_format("placed", _TS)
    return o.select(
        (k + 1).cast("string").alias("AbsEntry"),
        F.when(k % 33 == 0, placed).when(k % 101 == 7, F.date_format("placed", _BR))
        .otherwise(F.date_format("o_orderdate", _DAY)).alias("PickDate"),
        F.when(k % 29 == 0, F.concat(F.lit(" "), F.lower(letter), F.lit(" "))).otherwise(letter).alias("Status"),
        _code("PD", k + 1, 12).alias("U_CodPedido"),
        F.when(k % 89 == 4, F.date_format("placed", _BR)).otherwise(placed).alias("U_DataPedido"),
        F.when(k % 500 != 3, _code("C", F.col("o_custkey") + 1, 9)).alias("U_CodCliente"),
        _code("F", F.floor(F.col("o_custkey") / 15) + 1, 6).alias("U_Filial"),
        F.when(done, _code("O", F.col("o_custkey") % 500 + 1, 4)).alias("U_IdSeparador"),
        stage(F.lit(2)).alias("U_ProntoParaImpressao"), stage(start).alias("U_EmSeparacao"),
        stage(ready).alias("U_ProntoParaConferencia"), stage(checking).alias("U_EmConferencia"),
        stage(checked).alias("U_Conferido"), stage(left).alias("U_Saida"),
        _code("T", k % 20 + 1, 3).alias("U_CodTransp"),
        F.date_format("o_orderdate", _DAY).alias("CreateDate"),
        F.when(done, stage(left)).otherwise(F.date_format(F.timestamp_add("MINUTE", F.col("v") * 30, F.col("placed")), _TS)).alias("UpdateDate"),
    )


def opkl1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines from lineitem, whose (order, line) pairs repeat. ``ExtractTs`` is when a row was extracted."""
    li = _read(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("decimal(18,2)").cast("string")
    text = F.when(F.col("l_partkey") % 20 == 0, F.replace(quantity, F.lit("."), F.lit(","))).otherwise(quantity)
    unknown = (F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.0)
    return li.select(
        (F.col("l_orderkey") + 1).cast("string").alias("AbsEntry"),
        F.col("l_linenumber").cast("string").alias("PickEntry"),
        (F.col("l_orderkey") + 1).cast("string").alias("OrderEntry"),
        F.col("l_linenumber").cast("string").alias("OrderLine"),
        F.when((F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1), F.lit(None).cast("string"))
        .when(unknown, _code("X", F.col("l_partkey") + 1, 9)).otherwise(_code("P", F.col("l_partkey") + 1, 9)).alias("ItemCode"),
        text.alias("RelQtty"),
        F.when(F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "F", "0")).otherwise(text).alias("PickQtty"),
        F.date_format("l_shipdate", _TS).alias("ExtractTs"),
    )


def oitm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from part; economy parts come again with a new creation date, small ones with the same."""
    p = _read(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    copies = F.when(F.col("p_type").isin("ECONOMY", "SMALL"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    p = p.withColumn("v", F.explode(copies))
    tenth = (size.cast("decimal(18,3)") / 10).cast("decimal(18,3)").cast("string")
    again = F.when(F.col("p_type") == "ECONOMY", F.col("v")).otherwise(1)
    return p.select(
        _code("P", k + 1, 9).alias("ItemCode"),
        F.concat("p_name", F.lit(" "), F.col("v").cast("string")).alias("ItemName"),
        (101 + size % 14).cast("string").alias("ItmsGrpCod"),
        F.lit("UN").alias("SalUnitMsr"), F.col("p_brand").alias("BuyUnitMsr"),
        F.when(size != 50, F.when(k % 20 == 0, F.replace(tenth, F.lit("."), F.lit(","))).otherwise(tenth)).alias("SWeight1"),
        size.cast("string").alias("SLength1"),
        F.when(k % 77 == 1, "n/a").otherwise((size + 1).cast("string")).alias("SWidth1"),
        F.concat(size.cast("string"), F.lit(",5")).alias("SHeight1"),
        _code("789", k, 10).alias("CodeBars"), F.when(size > 45, "N").otherwise("Y").alias("validFor"),
        F.when(k % 3 == 0, F.concat(F.lit("1994-0"), again.cast("string"), F.lit("-10")))
        .otherwise(F.concat(F.lit("1994-0"), again.cast("string"), F.lit("-10 08:00:00"))).alias("CreateDate"),
    )


def ocrd(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Customers as of the first or second load. Customers in debt appear with the second, builders
    move by then, and machinery customers come with an outdated copy."""
    c = _read(spark, sf_dir, "customer")
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    if load == 1:
        c = c.where(F.col("c_acctbal") >= 0)
    copies = F.when(F.col("c_mktsegment") == "MACHINERY", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    c = c.withColumn("v", F.explode(copies))
    moved = F.when((F.col("c_mktsegment") == "BUILDING") & F.lit(load == 2), 1).otherwise(0)
    stamp = FIRST_LOAD if load == 1 else SECOND_LOAD
    return c.select(
        _code("C", k + 1, 9).alias("CardCode"),
        F.when(F.col("v") == 0, F.concat(F.lit("OLD "), "c_name")).otherwise(F.col("c_name")).alias("CardName"),
        _code("", k, 14).alias("LicTradNum"),
        F.concat(F.lit("Contact"), k.cast("string"), F.lit("@Example.COM")).alias("E_Mail"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.lower(_state(nation)), F.lit(" "))).otherwise(_state(nation)).alias("State1"),
        F.concat(F.lit("City "), (nation + moved).cast("string")).alias("City"),
        _code("", nation, 8).alias("ZipCode"),
        F.concat(F.lit("Rua "), k.cast("string")).alias("Address"),
        F.when(nation != 7, _code("55", k, 9)).alias("Phone1"),
        F.lit("Y").alias("validFor"),
        F.lit(stamp).alias("CreateDate"),
        F.when(F.col("v") == 0, "1994-12-01 00:00:00").when(F.col("c_mktsegment") != "HOUSEHOLD", stamp).alias("UpdateDate"),
    )


def owhs(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Branches from supplier; those of the first region change state by the second load."""
    s = _read(spark, sf_dir, "supplier").join(
        _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    k, nation = F.col("s_suppkey"), F.col("s_nationkey")
    moved = F.when((F.col("n_regionkey") == 0) & F.lit(load == 2), 2).otherwise(0)
    state = _state(nation + moved)
    return s.select(
        _code("F", k + 1, 6).alias("WhsCode"),
        F.concat(F.lit("Depot "), "s_name").alias("WhsName"),
        F.when(k % 2 == 0, F.lower(state)).otherwise(state).alias("State"),
        F.concat(F.lit("City "), nation.cast("string")).alias("City"),
        _code("", nation, 8).alias("ZipCode"),
        F.when(nation != 11, F.concat(F.lit("Rua "), k.cast("string"))).alias("Street"),
    )


def downtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downtime records from events, moved back over the years of the orders. Errors stop a whole branch."""
    e = _read(spark, sf_dir, "events")
    k = F.col("event_id")
    e = e.withColumn("a", F.date_trunc("MINUTE", F.expr("timestampadd(DAY, -(8200 + event_id % 2400), ts)")).cast("timestamp_ntz"))
    e = e.withColumn("b", F.expr("timestampadd(MINUTE, cast(floor(value) as int) + 5, a)"))
    return e.select(
        F.concat(_code("F", F.col("user_id") + 1, 6), F.lit(" - Depot "), _state(F.col("user_id"))).alias("Filial"),
        F.when(F.col("event_type") == "error", "0").otherwise((k + 1).cast("string")).alias("CodPickList"),
        F.date_format("a", _DAY).alias("DataParada"), F.hour("a").cast("string").alias("HoraParada"), F.minute("a").cast("string").alias("MinutoParada"),
        F.date_format("b", _DAY).alias("DataRetorno"), F.hour("b").cast("string").alias("HoraRetorno"), F.minute("b").cast("string").alias("MinutoRetorno"),
        F.concat(F.lit("Reason "), (k % 15).cast("string")).alias("Motivo"),
        F.concat("event_type", F.lit("@Example.com")).alias("Email"),
    )


def ousr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickers from customers, without a code for those of one nation; those in debt come twice, with another department."""
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    c = c.withColumn("v", F.explode(F.when(F.col("c_acctbal") < 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    return c.select(
        F.when(F.col("c_nationkey") != 3, _code("O", k + 1, 9)).alias("USER_CODE"), F.col("c_name").alias("U_NAME"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("v").cast("string")).alias("Department"),
        F.when(F.col("c_nationkey") != 7, _state(F.col("c_nationkey"))).alias("Branch"))


def oshp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carriers from suppliers; those in debt come twice, with another site."""
    s = _read(spark, sf_dir, "supplier")
    s = s.withColumn("v", F.explode(F.when(F.col("s_acctbal") < 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    return s.select(_code("T", F.col("s_suppkey") + 1, 6).alias("TrnspCode"), F.col("s_name").alias("TrnspName"),
                    F.when(F.col("s_nationkey") != 7, F.concat(F.lit("www."), F.col("v").cast("string"), F.lit(".example.com"))).alias("WebSite"))
