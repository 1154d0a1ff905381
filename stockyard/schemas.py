"""Table layouts. Clock and business times carry no time zone."""

from pyspark.sql import types as T

# Raw extract columns; every raw column is read as text.
RAW_COLUMNS = {
    "OCRD": "CardCode CardName LicTradNum E_Mail State1 City ZipCode Address Phone1 CreateDate UpdateDate validFor",
    "OWHS": "WhsCode WhsName State City ZipCode Street",
    "OITM": "ItemCode ItemName ItmsGrpCod SalUnitMsr BuyUnitMsr SWeight1 SLength1 SWidth1 SHeight1 CodeBars validFor CreateDate",
    "OPKL": "AbsEntry PickDate Status U_CodPedido U_DataPedido U_CodCliente U_Filial U_IdSeparador U_ProntoParaImpressao "
            "U_EmSeparacao U_ProntoParaConferencia U_EmConferencia U_Conferido U_Saida U_CodTransp CreateDate UpdateDate",
    "OPKL1": "AbsEntry PickEntry OrderEntry OrderLine ItemCode RelQtty PickQtty",
    "AUX_Desconsideracoes": "Filial CodPickList DataParada HoraParada MinutoParada DataRetorno HoraRetorno MinutoRetorno Motivo Email",
    "OUSR": "USER_CODE U_NAME Department Branch",
    "OSHP": "TrnspCode TrnspName WebSite",
}

# Silver and Gold columns.
_DIM_DATA = "data_sk INT, date_id INT, data DATE, ano INT, trimestre INT, mes INT, dia INT, dia_semana INT, " \
            "nome_mes STRING, mes_abrev STRING, nome_dia STRING"
_CUSTOMER = "customer_name STRING, tax_id STRING, email STRING, state STRING, city STRING, zip_code STRING, " \
            "address STRING, phone STRING, is_active STRING"
_BRANCH = "branch_name STRING, state STRING, city STRING, zip_code STRING, street STRING"
_VALIDITY = "effective_start TIMESTAMP_NTZ, effective_end TIMESTAMP_NTZ"
_PRODUCT = "product_name STRING, category_id STRING, sales_unit STRING, buy_unit STRING, weight DECIMAL(18,3), " \
           "length DECIMAL(18,2), width DECIMAL(18,2), height DECIMAL(18,2), barcode STRING, is_active STRING, " \
           "created_at TIMESTAMP_NTZ, row_hash STRING"
_COMPANY = "codigo INT, nome STRING, empresa_estoque INT, cod_filial STRING, razao_social STRING, uf STRING, " \
           "cidade STRING, bairro STRING, endereco STRING, cep STRING, supervisor STRING, centro_de_custo STRING, porte STRING"
_HOURS = "cod_filial STRING, filial STRING, hora_inicio TIMESTAMP_NTZ, hora_primeiro_pedido TIMESTAMP_NTZ, " \
         "hora_almoco_inicio TIMESTAMP_NTZ, hora_almoco_fim TIMESTAMP_NTZ, hora_ultimo_pedido TIMESTAMP_NTZ, " \
         "hora_fim TIMESTAMP_NTZ, total_hora_de_trabalho_sem_almoco TIMESTAMP_NTZ, " \
         "total_hora_de_trabalho_com_almoco TIMESTAMP_NTZ, pausa_para_almoco BOOLEAN, supervisor STRING"

_DDL = {
    "silver.opkl_clean":
        "pick_list_id STRING, pick_date DATE, status STRING, order_id STRING, data_pedido TIMESTAMP_NTZ, customer_id STRING, "
        "branch_id STRING, separator_id STRING, pronto_impressao TIMESTAMP_NTZ, em_separacao TIMESTAMP_NTZ, "
        "pronto_conferencia TIMESTAMP_NTZ, em_conferencia TIMESTAMP_NTZ, conferido TIMESTAMP_NTZ, saida TIMESTAMP_NTZ, "
        "cod_transp STRING, created_at TIMESTAMP_NTZ, row_hash STRING",
    "silver.opkl1_clean":
        "pick_list_id STRING, pick_line_id STRING, order_id STRING, item_code STRING, rel_quantity DECIMAL(18,2), "
        "pick_quantity DECIMAL(18,2), updated_at TIMESTAMP_NTZ, row_hash STRING",
    "silver.dim_produto": f"product_id STRING, {_PRODUCT}",
    "silver.dim_filial_scd": f"branch_sk BIGINT, branch_id STRING, {_BRANCH}, {_VALIDITY}, is_current BOOLEAN, row_hash STRING",
    "silver.dim_cliente_scd": f"customer_sk BIGINT, customer_id STRING, {_CUSTOMER}, {_VALIDITY}, is_current BOOLEAN, row_hash STRING",
    "silver.dim_empresas": f"empresa_sk BIGINT, {_COMPANY}, is_current BOOLEAN, {_VALIDITY}",
    "silver.dim_filiais_horarios": _HOURS,
    "silver.dim_data": _DIM_DATA,
    "silver.dim_operador": "user_code STRING, user_name STRING, department STRING, region STRING, row_hash STRING",
    "silver.dim_transportadora": "carrier_code STRING, carrier_name STRING, website STRING, row_hash STRING",
    "gold.dim_produto": f"product_sk BIGINT, nk_product_id STRING, {_PRODUCT}",
    "gold.dim_cliente": f"customer_sk BIGINT, nk_customer_id STRING, {_CUSTOMER}, {_VALIDITY}, row_hash STRING",
    "gold.dim_cliente_scd": f"customer_sk BIGINT, customer_id STRING, {_CUSTOMER}, {_VALIDITY}, is_current BOOLEAN, row_hash STRING",
    "gold.dim_filial": f"branch_sk BIGINT, nk_branch_id STRING, {_BRANCH}, {_VALIDITY}, row_hash STRING",
    "gold.dim_filial_scd": f"branch_sk BIGINT, branch_id STRING, {_BRANCH}, {_VALIDITY}, is_current BOOLEAN, row_hash STRING",
    "gold.dim_empresas": f"empresa_sk BIGINT, {_COMPANY}",
    "gold.dim_filiais_horarios": _HOURS,
    "gold.dim_data": _DIM_DATA,
    "gold.separation_bins": "Filial STRING, day DATE, sign INT, bin BIGINT, n BIGINT",
    "silver.opkl_versions": "pick_list_id STRING, update_date TIMESTAMP_NTZ, row_hash STRING",
    "gold.fact_picklists":
        "CodPickList STRING, DataPickList TIMESTAMP_NTZ, CodPedido STRING, DataPedido TIMESTAMP_NTZ, NF STRING, "
        "DataNota TIMESTAMP_NTZ, DocNumNF STRING, Volume BIGINT, PesoBruto DECIMAL(18,4), CodCliente STRING, "
        "TipoEstoque STRING, Filial STRING, QtdSKU BIGINT, QtdPecas DECIMAL(18,2), QtdSN BIGINT, "
        "ProntoParaImpressao TIMESTAMP_NTZ, IdSeparador STRING, UserSeparador STRING, EmSeparacao TIMESTAMP_NTZ, "
        "ProntoParaConferencia TIMESTAMP_NTZ, IdConferente STRING, UserConferente STRING, EmConferencia TIMESTAMP_NTZ, "
        "Conferido TIMESTAMP_NTZ, IdExpedidor STRING, UserExpedidor STRING, Saida TIMESTAMP_NTZ, IdRomaneio STRING, "
        "DataRomaneio TIMESTAMP_NTZ, Cancelado STRING, StatusDocumento STRING, TipoFrete STRING, CodTransp STRING, "
        "Supervisor STRING, Regra_PedidoFracionado STRING, Regra_SKU_SN STRING, Regra_Retira_NossoCarro STRING, "
        "ProntoParaImpressaoAjustado TIMESTAMP_NTZ, sla_segundos BIGINT, sla_HHMMSS TIMESTAMP_NTZ, "
        "Atualizado TIMESTAMP_NTZ, fk_data_sk INT, fk_empresa_sk BIGINT, fk_cliente_sk BIGINT, row_hash STRING",
}

_parsed: dict = {}


def schema(table: str) -> T.StructType:
    """Layout of ``layer.table``."""
    if table not in _parsed:
        _parsed[table] = T.StructType.fromDDL(_DDL[table])
    return _parsed[table]


def raw_schema(extract: str) -> T.StructType:
    """Layout of a raw extract: all text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[extract].split()])


def tables() -> list[str]:
    return list(_DDL)


def conform(df, table: str, *extra: str):
    """Select and cast ``df`` to the layout of ``table``, keeping ``extra`` columns."""
    fields = schema(table).fields
    kept = [c for c in extra if c not in schema(table).names]
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields], *kept)


def empty(spark, table: str):
    """The target of a first run. Catalyst sees that it is empty and drops joins with it."""
    return spark.range(1).where("false").selectExpr(
        *[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema(table)])
