"""The registered queries restated in plain SQL, as an independent check.

Nothing here is used by the library. Each text is a chain of common table expressions that
derives the raw extracts and the tables in SQL, followed by one select per query.
"""

from stockyard.plans.registry import BACKLOG_DAY, CALENDAR, SLA_TARGET
from stockyard.plans.sample_feed import FIRST_LOAD, HORIZON, SECOND_LOAD, STATES

_TS, _BR = "%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S"
_END = "TIMESTAMP '9999-12-31 00:00:00'"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _state(n: str) -> str:
    return f"{_list(STATES)}[CAST(({n}) % {len(STATES)} AS INTEGER) + 1]"


def _ts(column: str, *formats: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({column}, '{f}')" for f in formats) + ")"


def _ts_text(c: str) -> str:
    return f"coalesce(strftime({c}, '{_TS}'), '')"


def _filled(c: str) -> str:
    return f"coalesce({c}, '')"


def _number(c: str, scale: int) -> str:
    return f"CAST(coalesce({c}, CAST(0 AS DECIMAL(18,{scale}))) AS VARCHAR)"


def _sha(*parts: str) -> str:
    return "sha256(concat_ws('||', " + ", ".join(parts) + "))"


def _ranked(source: str, keys: str, order: list[str], where: str = "") -> str:
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS rn
        FROM {source} {where}) WHERE rn = 1"""


_HEADER_KEPT = ["status", "order_id", "data_pedido", "customer_id", "branch_id", "separator_id", "pronto_impressao", "em_separacao",
                "pronto_conferencia", "em_conferencia", "conferido", "saida", "cod_transp"]
_HEADER_TIMES = {"data_pedido", "pronto_impressao", "em_separacao", "pronto_conferencia", "em_conferencia", "conferido", "saida"}
_HEADER_SHA = _sha("coalesce(strftime(pick_date, '%Y-%m-%d'), '')", *[_ts_text(c) if c in _HEADER_TIMES else _filled(c) for c in _HEADER_KEPT])
_CUSTOMER = ["customer_name", "tax_id", "email", "state", "city", "zip_code", "address", "phone", "is_active"]
_BRANCH = ["branch_name", "state", "city", "zip_code", "street"]
_PRODUCT = ["product_name", "category_id", "sales_unit", "buy_unit", "weight", "length", "width", "height", "barcode", "is_active"]
_PRODUCT_SHA = _sha(*[_number(c, 3) if c == "weight" else _number(c, 2) if c in ("length", "width", "height") else _filled(c) for c in _PRODUCT])
_LINE_SHA = _sha("coalesce(order_id, '')", "coalesce(item_code, '')", _number("rel_quantity", 2), _number("pick_quantity", 2))

_CTES: dict[str, str] = {}

_CTES["opkl"] = f"""
    SELECT CAST(k + 1 AS VARCHAR) AS "AbsEntry",
        CASE WHEN k % 33 = 0 THEN placed_text WHEN k % 101 = 7 THEN strftime(placed, '{_BR}') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "PickDate",
        CASE WHEN k % 29 = 0 THEN ' ' || lower(letter) || ' ' ELSE letter END AS "Status",
        'PD' || lpad(CAST(k + 1 AS VARCHAR), 12, '0') AS "U_CodPedido",
        CASE WHEN k % 89 = 4 THEN strftime(placed, '{_BR}') ELSE placed_text END AS "U_DataPedido",
        CASE WHEN k % 500 <> 3 THEN 'C' || lpad(CAST(o_custkey + 1 AS VARCHAR), 9, '0') END AS "U_CodCliente",
        'F' || lpad(CAST(o_custkey // 15 + 1 AS VARCHAR), 6, '0') AS "U_Filial",
        CASE WHEN done THEN 'O' || lpad(CAST(o_custkey % 500 + 1 AS VARCHAR), 4, '0') END AS "U_IdSeparador",
        CASE WHEN done THEN strftime(placed + to_minutes(2), '{_TS}') END AS "U_ProntoParaImpressao",
        CASE WHEN done THEN strftime(placed + to_minutes(m_start), '{_TS}') END AS "U_EmSeparacao",
        CASE WHEN done THEN strftime(placed + to_minutes(m_ready), '{_TS}') END AS "U_ProntoParaConferencia",
        CASE WHEN done THEN strftime(placed + to_minutes(m_ready + 1 + k % 4), '{_TS}') END AS "U_EmConferencia",
        CASE WHEN done THEN strftime(placed + to_minutes(m_ready + 3 + k % 4 + k % 6), '{_TS}') END AS "U_Conferido",
        CASE WHEN done THEN strftime(placed + to_minutes(m_left), '{_TS}') END AS "U_Saida",
        'T' || lpad(CAST(k % 20 + 1 AS VARCHAR), 3, '0') AS "U_CodTransp",
        strftime(o_orderdate, '%Y-%m-%d') AS "CreateDate",
        strftime(placed + to_minutes(CASE WHEN done THEN m_left ELSE v * 30 END), '{_TS}') AS "UpdateDate"
    FROM (SELECT *, strftime(placed, '{_TS}') AS placed_text, o_orderstatus = 'F' AND v = 1 AS done,
              CASE WHEN o_orderstatus = 'F' AND v = 1 THEN 'E' WHEN o_orderstatus = 'P' AND v = 1 THEN 'C' ELSE 'P' END AS letter,
              m_ready + 3 + k % 4 + k % 6 + 60 * (1 + k % 3) AS m_left
          FROM (SELECT *, m_start + CASE WHEN k % 997 = 5 THEN -5 ELSE 13 + k % 15 END AS m_ready
                FROM (SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_orderdate + to_minutes(480 + o_orderkey % 480) AS placed,
                          4 + o_orderkey % 13 AS m_start,
                          unnest(CASE WHEN o_orderpriority = '1-URGENT' THEN [0, 1] ELSE [1] END) AS v FROM orders)))"""
_CTES["opkl1"] = f"""
    SELECT CAST(l_orderkey + 1 AS VARCHAR) AS "AbsEntry", CAST(l_linenumber AS VARCHAR) AS "PickEntry", CAST(l_orderkey + 1 AS VARCHAR) AS "OrderEntry",
        CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN NULL WHEN l_tax = 0.08 AND l_discount = 0.0 THEN 'X' || lpad(CAST(l_partkey + 1 AS VARCHAR), 9, '0')
             ELSE 'P' || lpad(CAST(l_partkey + 1 AS VARCHAR), 9, '0') END AS "ItemCode",
        qty AS "RelQtty",
        CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN '0' END ELSE qty END AS "PickQtty",
        l_shipdate AS extracted
    FROM (SELECT *, CASE WHEN l_partkey % 20 = 0 THEN replace(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
                    ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS qty FROM lineitem)"""
_RAW_HEADER = """AbsEntry PickDate Status U_CodPedido U_DataPedido U_CodCliente U_Filial U_IdSeparador U_ProntoParaImpressao U_EmSeparacao
    U_ProntoParaConferencia U_EmConferencia U_Conferido U_Saida U_CodTransp CreateDate UpdateDate""".split()
_CTES["header_staged"] = f"""
    SELECT "AbsEntry" AS pick_list_id, {_ts('"PickDate"', _TS, '%Y-%m-%d')} AS pick_ts, upper(trim("Status")) AS status, "U_CodPedido" AS order_id,
        {_ts('"U_DataPedido"', _TS)} AS data_pedido, "U_CodCliente" AS customer_id, "U_Filial" AS branch_id, "U_IdSeparador" AS separator_id,
        {_ts('"U_ProntoParaImpressao"', _TS)} AS pronto_impressao, {_ts('"U_EmSeparacao"', _TS)} AS em_separacao,
        {_ts('"U_ProntoParaConferencia"', _TS)} AS pronto_conferencia, {_ts('"U_EmConferencia"', _TS)} AS em_conferencia,
        {_ts('"U_Conferido"', _TS)} AS conferido, {_ts('"U_Saida"', _TS)} AS saida, "U_CodTransp" AS cod_transp,
        {_ts('"UpdateDate"', _TS)} AS update_date
    FROM opkl WHERE "AbsEntry" IS NOT NULL"""


def _header_from(staged: str) -> str:
    ranked = _ranked(staged, "pick_list_id", ["update_date", "pick_ts", *_HEADER_KEPT], "WHERE pick_ts IS NOT NULL")
    return f"""SELECT *, {_HEADER_SHA} AS row_hash FROM (
        SELECT pick_list_id, CAST(pick_ts AS DATE) AS pick_date, {', '.join(_HEADER_KEPT)}, pick_ts AS created_at FROM ({ranked}))"""


def _lines_from(staged: str) -> str:
    ranked = _ranked(staged, "pick_list_id, pick_line_id", ["updated_at", "order_id", "item_code", "rel_quantity", "pick_quantity"])
    return f"SELECT *, {_LINE_SHA} AS row_hash FROM ({ranked})"


_CTES["header"] = _header_from("header_staged")
_CTES["lines_staged"] = """
    SELECT "AbsEntry" AS pick_list_id, "PickEntry" AS pick_line_id, "OrderEntry" AS order_id, "ItemCode" AS item_code,
        TRY_CAST(replace("RelQtty", ',', '.') AS DECIMAL(18,2)) AS rel_quantity, TRY_CAST(replace("PickQtty", ',', '.') AS DECIMAL(18,2)) AS pick_quantity,
        extracted AS updated_at
    FROM opkl1 WHERE "AbsEntry" IS NOT NULL AND "PickEntry" IS NOT NULL"""
_CTES["lines"] = _lines_from("lines_staged")
_CTES["products_staged"] = f"""
    SELECT 'P' || lpad(CAST(p_partkey + 1 AS VARCHAR), 9, '0') AS product_id, p_name || ' ' || CAST(v AS VARCHAR) AS product_name,
        CAST(101 + p_size % 14 AS VARCHAR) AS category_id, 'UN' AS sales_unit, p_brand AS buy_unit,
        CASE WHEN p_size <> 50 THEN CAST(CAST(p_size AS DECIMAL(18,3)) / 10 AS DECIMAL(18,3)) END AS weight,
        CAST(p_size AS DECIMAL(18,2)) AS length, CASE WHEN p_partkey % 77 <> 1 THEN CAST(p_size + 1 AS DECIMAL(18,2)) END AS width,
        CAST(CAST(p_size AS VARCHAR) || '.5' AS DECIMAL(18,2)) AS height,
        '789' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS barcode, CASE WHEN p_size > 45 THEN 'N' ELSE 'Y' END AS is_active,
        CASE WHEN p_type = 'ECONOMY' AND v = 2 THEN TIMESTAMP '1994-02-10' ELSE TIMESTAMP '1994-01-10' END
            + CASE WHEN p_partkey % 3 = 0 THEN INTERVAL 0 HOUR ELSE INTERVAL 8 HOUR END AS created_at
    FROM (SELECT *, unnest(CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN [1, 2] ELSE [1] END) AS v FROM part)"""
_CTES["products"] = f"SELECT *, {_PRODUCT_SHA} AS row_hash FROM ({_ranked('products_staged', 'product_id', ['created_at', *_PRODUCT])})"
for _load, _stamp in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
    _moved = "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END" if _load == 2 else "0"
    _CTES[f"ocrd{_load}"] = f"""
    SELECT 'C' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') AS "CardCode", CASE WHEN v = 0 THEN 'OLD ' ELSE '' END || c_name AS "CardName",
        lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS "LicTradNum", 'Contact' || CAST(c_custkey AS VARCHAR) || '@Example.COM' AS "E_Mail",
        CASE WHEN c_custkey % 3 = 0 THEN ' ' || lower({_state('c_nationkey')}) || ' ' ELSE {_state('c_nationkey')} END AS "State1",
        'City ' || CAST(c_nationkey + {_moved} AS VARCHAR) AS "City", lpad(CAST(c_nationkey AS VARCHAR), 8, '0') AS "ZipCode",
        'Rua ' || CAST(c_custkey AS VARCHAR) AS "Address", CASE WHEN c_nationkey <> 7 THEN '55' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS "Phone1",
        'Y' AS "validFor", '{_stamp}' AS "CreateDate",
        CASE WHEN v = 0 THEN '1994-12-01 00:00:00' WHEN c_mktsegment <> 'HOUSEHOLD' THEN '{_stamp}' END AS "UpdateDate"
    FROM (SELECT *, unnest(CASE WHEN c_mktsegment = 'MACHINERY' THEN [0, 1] ELSE [1] END) AS v FROM customer
          {"WHERE c_acctbal >= 0" if _load == 1 else ""})"""
    _CTES[f"customers_staged{_load}"] = f"""
    SELECT "CardCode" AS customer_id, "CardName" AS customer_name, "LicTradNum" AS tax_id, lower("E_Mail") AS email, upper(trim("State1")) AS state,
        "City" AS city, "ZipCode" AS zip_code, "Address" AS address, "Phone1" AS phone, "validFor" AS is_active,
        coalesce({_ts('"UpdateDate"', _TS)}, {_ts('"CreateDate"', _TS)}) AS src_ts
    FROM ocrd{_load} WHERE "CardCode" IS NOT NULL"""
    _ties = ["src_ts", "customer_name", *[c for c in _CUSTOMER if c != "customer_name"]]
    _CTES[f"customers{_load}"] = f"SELECT *, {_sha(*map(_filled, _CUSTOMER))} AS row_hash FROM ({_ranked(f'customers_staged{_load}', 'customer_id', _ties)})"
    _shift = "CASE WHEN n_regionkey = 0 THEN 2 ELSE 0 END" if _load == 2 else "0"
    _CTES[f"branches{_load}"] = f"""SELECT *, {_sha(*map(_filled, _BRANCH))} AS row_hash FROM (
    SELECT 'F' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 6, '0') AS branch_id, 'Depot ' || s_name AS branch_name,
        {_state(f's_nationkey + {_shift}')} AS state, 'City ' || CAST(s_nationkey AS VARCHAR) AS city, lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS zip_code,
        CASE WHEN s_nationkey <> 11 THEN 'Rua ' || CAST(s_suppkey AS VARCHAR) END AS street, TIMESTAMP '{_stamp}' AS src_ts
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def _history(first: str, second: str, nk: str, sk: str, attributes: list[str], late: str = "") -> str:
    """Versions after two snapshots: the first ones, and those the second one opens."""
    cols = ", ".join(f"b.{c}" for c in attributes)
    cols_a = ", ".join(f"a.{c}" for c in attributes)
    return f"""
    SELECT row_number() OVER (ORDER BY a.{nk}) AS {sk}, a.{nk}, {cols_a}, a.src_ts AS effective_start,
        CASE WHEN b.row_hash <> a.row_hash THEN b.src_ts ELSE {_END} END AS effective_end, NOT coalesce(b.row_hash <> a.row_hash, FALSE) AS is_current, a.row_hash
    FROM {first} a LEFT JOIN {second} b ON a.{nk} = b.{nk}
    UNION ALL
    SELECT (SELECT count(*) FROM {first}) + row_number() OVER (ORDER BY b.{nk}), b.{nk}, {cols}, b.src_ts, {_END}, TRUE, b.row_hash
    FROM {second} b LEFT JOIN {first} a ON a.{nk} = b.{nk} WHERE a.{nk} IS NULL OR a.row_hash <> b.row_hash"""


def _first_history(first: str, nk: str, sk: str, attributes: list[str]) -> str:
    return f"""SELECT row_number() OVER (ORDER BY {nk}) AS {sk}, {nk}, {', '.join(attributes)}, src_ts AS effective_start, {_END} AS effective_end,
        TRUE AS is_current, row_hash FROM {first}"""


_CTES["customer_history"] = _history("customers1", "customers2", "customer_id", "customer_sk", _CUSTOMER)
_CTES["branch_history"] = _history("branches1", "branches2", "branch_id", "branch_sk", _BRANCH)
_CTES["late_history"] = f"""
    SELECT h.* REPLACE (CASE WHEN h.is_current AND l.row_hash <> h.row_hash THEN l.src_ts ELSE h.effective_end END AS effective_end,
                        h.is_current AND NOT coalesce(l.row_hash <> h.row_hash, FALSE) AS is_current)
    FROM customer_history h LEFT JOIN customers1 l ON h.customer_id = l.customer_id
    UNION ALL
    SELECT (SELECT max(customer_sk) FROM customer_history) + row_number() OVER (ORDER BY l.customer_id), l.customer_id,
        {', '.join(f'l.{c}' for c in _CUSTOMER)}, l.src_ts, {_END}, TRUE, l.row_hash
    FROM customers1 l WHERE NOT EXISTS (SELECT 1 FROM customer_history h WHERE h.customer_id = l.customer_id AND h.is_current AND h.row_hash = l.row_hash)"""


# Fixed values, restated here so that a wrong one in the library does not pass.
def _supervisor(state: str) -> str:
    return f"""CASE WHEN {state} IN ('AC', 'AL', 'AM', 'AP', 'BA', 'CE', 'MA', 'PA', 'PB', 'PE', 'PI', 'RN', 'RO', 'RR', 'SE', 'TO') THEN 'Roberto Carlos'
        WHEN {state} IN ('DF', 'GO', 'MS', 'MT') THEN 'Mariana Silva' WHEN {state} IN ('ES', 'MG', 'RJ', 'SP') THEN 'Thiago Mendes'
        WHEN {state} IN ('PR', 'RS', 'SC') THEN 'Beatriz Souza' ELSE 'Não Atribuído' END"""


def _cost_center(code: str) -> str:
    return f"""CASE {code} WHEN 1 THEN '9301' WHEN 3 THEN '9104' WHEN 4 THEN '9105' WHEN 5 THEN '9106' WHEN 6 THEN '9001' WHEN 7 THEN '9002'
        WHEN 8 THEN '9003' WHEN 9 THEN '9005' WHEN 11 THEN '9006' WHEN 12 THEN '9201' WHEN 13 THEN '9202' WHEN 14 THEN '9203' WHEN 15 THEN '9204'
        WHEN 17 THEN '9304' WHEN 18 THEN '9305' WHEN 19 THEN '9302' WHEN 20 THEN '9304' WHEN 21 THEN '9004' WHEN 22 THEN '9103' WHEN 23 THEN '9101'
        WHEN 24 THEN '9102' WHEN 25 THEN '9205' ELSE 'Ajustar' END"""


_MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]
_WEEKDAYS = ["segunda", "terça", "quarta", "quinta", "sexta", "sábado", "domingo"]
_NINE, _SIX = "1899-12-30 09:00:00", "1899-12-30 18:00:00"
_OPEN = {"hora_inicio": _NINE, "hora_primeiro_pedido": "1899-12-30 09:30:00", "hora_almoco_inicio": "1899-12-30 12:00:00", "hora_almoco_fim": "1899-12-30 13:00:00",
         "hora_ultimo_pedido": "1899-12-30 17:30:00", "hora_fim": _SIX, "total_hora_de_trabalho_sem_almoco": _NINE,
         "total_hora_de_trabalho_com_almoco": "1899-12-30 08:00:00"}


def _size(code: str) -> str:
    return f"CASE WHEN {code} IN (1, 9) THEN 'Grande' WHEN {code} IN (12, 18, 22) THEN 'Pequena' ELSE 'Média' END"


def _code(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^0-9]', '', 'g') AS INTEGER)"


_CTES["companies"] = f"""
    SELECT branch_sk AS empresa_sk, {_code('branch_id')} AS codigo, branch_name AS nome, {_code('branch_id')} AS empresa_estoque, branch_id AS cod_filial,
        branch_name AS razao_social, state AS uf, city AS cidade, '' AS bairro, street AS endereco, zip_code AS cep, {_supervisor('state')} AS supervisor,
        {_cost_center(_code('branch_id'))} AS centro_de_custo, {_size(_code('branch_id'))} AS porte, is_current, effective_start, effective_end
    FROM branch_history WHERE branch_id <> '_UNKNOWN_'"""


def _calendar(first: str, last: str) -> str:
    return f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS data_sk, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS data,
        CAST(year(d) AS INTEGER) AS ano, CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia,
        CAST(isodow(d) AS INTEGER) AS dia_semana, {_list(_MONTHS)}[month(d)] AS nome_mes,
        left({_list(_MONTHS)}[month(d)], 3) AS mes_abrev, {_list(_WEEKDAYS)}[isodow(d)] AS nome_dia
    FROM (SELECT unnest(generate_series(CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP), INTERVAL 1 DAY)) AS d)"""


_CTES["days"] = _calendar(f"'{CALENDAR[0]}'", f"'{CALENDAR[1]}'")
_CTES["order_days"] = _calendar("(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)")
_CTES["line_totals"] = """
    SELECT pick_list_id, count(DISTINCT item_code) AS "QtdSKU", CAST(sum(pick_quantity) AS DECIMAL(18,2)) AS "QtdPecas",
        CAST(sum(coalesce(pick_quantity, 0) * coalesce(weight, 0)) AS DECIMAL(18,4)) AS "PesoBruto"
    FROM lines LEFT JOIN products ON item_code = product_id GROUP BY pick_list_id"""


def _asof(dim: str, key: str) -> str:
    return f"""h.{key} = {dim}.{'cod_filial' if key == 'branch_id' else key} AND h.pick_date >= CAST({dim}.effective_start AS DATE)
        AND h.pick_date < CAST(coalesce({dim}.effective_end, {_END}) AS DATE)"""


_FACT_SHA = _sha('"CodPickList"', "CAST(fk_data_sk AS VARCHAR)", "CAST(fk_empresa_sk AS VARCHAR)", "CAST(fk_cliente_sk AS VARCHAR)", '"CodPedido"',
                 _ts_text('"DataPedido"'), '"CodCliente"', '"Filial"', '"StatusDocumento"', 'CAST("QtdPecas" AS VARCHAR)', 'CAST("QtdSKU" AS VARCHAR)',
                 *[_ts_text(f'"{c}"') for c in ("ProntoParaImpressao", "EmSeparacao", "ProntoParaConferencia", "EmConferencia", "Conferido", "Saida")],
                 _filled('"CodTransp"'))


def _fact_from(header: str, updated_at: str = SECOND_LOAD) -> str:
    return f"""SELECT *, {_FACT_SHA} AS row_hash FROM (
    SELECT h.pick_list_id AS "CodPickList", CAST(h.pick_date AS TIMESTAMP) AS "DataPickList", h.order_id AS "CodPedido", h.data_pedido AS "DataPedido",
        CAST(NULL AS VARCHAR) AS "NF", CAST(NULL AS TIMESTAMP) AS "DataNota", CAST(NULL AS VARCHAR) AS "DocNumNF", CAST(1 AS BIGINT) AS "Volume",
        coalesce(t."PesoBruto", 0) AS "PesoBruto", h.customer_id AS "CodCliente", 'M' AS "TipoEstoque", h.branch_id AS "Filial",
        coalesce(t."QtdSKU", 0) AS "QtdSKU", coalesce(t."QtdPecas", CAST(0 AS DECIMAL(18,2))) AS "QtdPecas", CAST(0 AS BIGINT) AS "QtdSN",
        h.pronto_impressao AS "ProntoParaImpressao", h.separator_id AS "IdSeparador", h.separator_id AS "UserSeparador", h.em_separacao AS "EmSeparacao",
        h.pronto_conferencia AS "ProntoParaConferencia", h.separator_id AS "IdConferente", h.separator_id AS "UserConferente",
        h.em_conferencia AS "EmConferencia", h.conferido AS "Conferido", h.separator_id AS "IdExpedidor", h.separator_id AS "UserExpedidor",
        h.saida AS "Saida", CAST(NULL AS VARCHAR) AS "IdRomaneio", CAST(NULL AS TIMESTAMP) AS "DataRomaneio",
        CASE WHEN h.status = 'C' THEN 'Y' ELSE 'N' END AS "Cancelado", h.status AS "StatusDocumento", '9' AS "TipoFrete", h.cod_transp AS "CodTransp",
        e.supervisor AS "Supervisor", 'Considerar' AS "Regra_PedidoFracionado", 'Considerar' AS "Regra_SKU_SN", 'Considerar' AS "Regra_Retira_NossoCarro",
        h.pronto_impressao AS "ProntoParaImpressaoAjustado", CAST(epoch(h.pronto_conferencia) - epoch(h.em_separacao) AS BIGINT) AS sla_segundos,
        CAST(NULL AS TIMESTAMP) AS "sla_HHMMSS", TIMESTAMP '{updated_at}' AS "Atualizado", d.data_sk AS fk_data_sk,
        coalesce(e.empresa_sk, 0) AS fk_empresa_sk, coalesce(c.customer_sk, 0) AS fk_cliente_sk
    FROM {header} h LEFT JOIN line_totals t ON h.pick_list_id = t.pick_list_id
        LEFT JOIN companies e ON {_asof('e', 'branch_id')}
        LEFT JOIN customer_history c ON {_asof('c', 'customer_id')}
        LEFT JOIN days d ON d.data = h.pick_date
    WHERE h.pick_date >= DATE '{HORIZON}')"""


_CTES["fact"] = _fact_from("header")
_CTES["early_header"] = _header_from(f"(SELECT * FROM header_staged WHERE update_date < TIMESTAMP '{SECOND_LOAD}')")
_CTES["early_fact"] = _fact_from("early_header", FIRST_LOAD)
_CTES["late_fact"] = _fact_from("header")
_CTES["downtime"] = f"""
    SELECT 'F' || lpad(CAST(user_id + 1 AS VARCHAR), 6, '0') AS branch_id, CASE WHEN event_type = 'error' THEN '0' ELSE CAST(event_id + 1 AS VARCHAR) END AS pick_list_id,
        a AS stopped_at, a + to_minutes(CAST(floor(value) AS BIGINT) + 5) AS resumed_at, 'Reason ' || CAST(event_id % 15 AS VARCHAR) AS reason
    FROM (SELECT *, date_trunc('minute', ts - to_days(CAST(8200 + event_id % 2400 AS INTEGER))) AS a FROM events)"""
_CTES["intervals"] = f"""
    SELECT o_custkey AS nk, o_orderdate AS effective_start,
        CASE WHEN o_orderstatus = 'P' THEN {_END} ELSE o_orderdate + to_days(CAST(CAST(trunc(o_totalprice) AS BIGINT) % 300 AS INTEGER)) END AS effective_end,
        o_orderpriority = '5-LOW' AS is_current, CASE WHEN o_orderpriority <> '2-HIGH' THEN 'h' END AS row_hash FROM orders"""

# The queries give decimals as text with all places of their scale, so the oracle does too.
def _all(source: str, decimals: list[str] = ()) -> str:
    casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in decimals)
    return f"SELECT * REPLACE ({casts}) FROM {source}" if casts else f"SELECT * FROM {source}"


_FACT_DECIMALS = ["PesoBruto", "QtdPecas"]
_SIZES = ["weight", "length", "width", "height"]


def _checks(table: str, counts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, CAST(coalesce(({sql}), 0) AS BIGINT) AS violations, coalesce(({sql}), 0) >= 1 AS breached"
        for name, sql in counts.items())


def _lead(table: str, nk: str, test: str) -> str:
    return f"""SELECT count(*) FROM (SELECT effective_end, lead(effective_start) OVER (PARTITION BY {nk} ORDER BY effective_start, effective_end) AS next_start
        FROM {table}) WHERE next_start IS NOT NULL AND effective_end {test} next_start"""


def _history_checks(table: str, nk: str) -> dict[str, str]:
    return {
        "scd_multi_curr": f"SELECT count(*) FROM (SELECT {nk} FROM {table} WHERE is_current GROUP BY {nk} HAVING count(*) > 1)",
        "scd_bad_range": f"SELECT count(*) FROM {table} WHERE effective_start >= effective_end",
        "scd_overlap": _lead(table, nk, ">"),
        "scd_missing_hash": f"SELECT count(*) FROM {table} WHERE row_hash IS NULL",
        "scd_curr_bad_end": f"SELECT count(*) FROM {table} WHERE is_current AND CAST(effective_end AS DATE) <> DATE '9999-12-31'",
        "scd_gap": _lead(table, nk, "<"),
    }


def _only(checks: dict[str, str], names: list[str]) -> dict[str, str]:
    return {n: checks[n] for n in names}


def _header_checks(source: str, row_hash: str = "row_hash") -> dict[str, str]:
    return {
        "duplicate_picklists": f"SELECT count(*) FROM (SELECT pick_list_id FROM {source} GROUP BY pick_list_id HAVING count(*) > 1)",
        "missing_hash": f"SELECT count(*) FROM {source} WHERE {row_hash} IS NULL",
        "invalid_dates": f"SELECT count(*) FROM {source} WHERE {'pick_ts' if source == 'header_staged' else 'pick_date'} IS NULL OR data_pedido IS NULL",
    }


_FACT_CHECKS = {
    "null_sk": "SELECT count(*) FROM fact WHERE fk_empresa_sk IS NULL OR fk_cliente_sk IS NULL OR fk_data_sk IS NULL",
    "missing_hash": "SELECT count(*) FROM fact WHERE row_hash IS NULL",
    "invalid_sla": "SELECT count(*) FROM fact WHERE sla_segundos < 0",
}
_FIVE = ["scd_multi_curr", "scd_bad_range", "scd_overlap", "scd_missing_hash", "scd_curr_bad_end"]
_THREE = ["scd_multi_curr", "scd_bad_range", "scd_overlap"]
_REPORT = " UNION ALL ".join([
    _checks("gold.fact_picklists", _FACT_CHECKS),
    _checks("silver.dim_cliente_scd", _only(_history_checks("customer_history", "customer_id"), [*_FIVE, "scd_gap"])),
    _checks("silver.dim_empresas", _only(_history_checks("companies", "cod_filial"), [*_THREE, "scd_gap"])),
    _checks("silver.opkl_clean", _header_checks("header")),
])


def _separation(by: str) -> str:
    return f"""SELECT "{by}", count(*) AS picklists, CAST(sum(sla_segundos) AS DOUBLE) / count(*) AS avg_seconds,
        CAST(round(quantile_cont(sla_segundos, 0.5)) AS BIGINT) AS p50_seconds, CAST(round(quantile_cont(sla_segundos, 0.9)) AS BIGINT) AS p90_seconds
    FROM fact WHERE sla_segundos IS NOT NULL GROUP BY "{by}\""""


def _versioned_sha(attributes: list[str]) -> str:
    return _sha(*map(_filled, attributes), _ts_text("effective_start"), _ts_text("effective_end"))


def _hours(cells: dict[str, str]) -> str:
    return ", ".join(f"TIMESTAMP '{t}' AS {name}" for name, t in cells.items())


def _opening(where: str) -> str:
    return f"SELECT cod_filial, nome AS filial, {_hours(_OPEN)}, porte = 'Pequena' AS pausa_para_almoco, supervisor FROM companies WHERE {where}"


_COMPANY = ["codigo", "nome", "empresa_estoque", "cod_filial", "razao_social", "uf", "cidade", "bairro", "endereco", "cep", "supervisor", "centro_de_custo", "porte"]
_UPDATED = " AND ".join(["t.row_hash <> s.row_hash"])


def _hash_upsert(target: str, source: str, keys: list[str], columns: list[str], decimals: list[str] = ()) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)

    def cell(c):
        value = f"CASE WHEN t.{keys[0]} IS NULL OR t.row_hash <> s.row_hash THEN s.{c} ELSE t.{c} END"
        return f"CAST({value} AS VARCHAR) AS {c}" if c in decimals else f"{value} AS {c}"
    return f"SELECT {', '.join(map(cell, columns))} FROM {target} t FULL JOIN {source} s ON {on}"


_CTES["stored_lines"] = _lines_from(f"(SELECT * FROM lines_staged WHERE updated_at < TIMESTAMP '{SECOND_LOAD}')")
_CTES["new_lines"] = _lines_from(f"(SELECT * FROM lines_staged WHERE updated_at >= TIMESTAMP '{HORIZON} 00:00:00')")

# Lines after two loads: what the second drop holds wins, and within a drop the greatest values.
_CTES["loaded_lines"] = f"SELECT *, {_LINE_SHA} AS row_hash FROM (" + _ranked(
    f"(SELECT *, CASE WHEN updated_at < TIMESTAMP '{SECOND_LOAD}' THEN 1 ELSE 2 END AS load FROM lines_staged)",
    "pick_list_id, pick_line_id", ["load", "order_id", "item_code", "rel_quantity", "pick_quantity"]) + ")"
_CTES["loaded_totals"] = _CTES["line_totals"].replace("FROM lines ", "FROM loaded_lines ")
_CTES["loaded_fact"] = _fact_from("header").replace("line_totals", "loaded_totals")
_PEOPLE_SHA = _sha(*map(_filled, ["user_name", "department", "region"]))
_CARRIER_SHA = _sha(*map(_filled, ["carrier_name", "website"]))

_SELECTS: dict[str, str] = {
    "bronze_drops": _all("opkl"),
    "bronze_recent": f"""SELECT * FROM opkl WHERE "UpdateDate" >= '{SECOND_LOAD}'""",
    "operator_dim": f"""SELECT user_code, user_name, department, region, {_PEOPLE_SHA} AS row_hash FROM (
        SELECT 'O' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') AS user_code, c_name AS user_name, c_mktsegment || ' 1' AS department,
            CASE WHEN c_nationkey <> 7 THEN {_state('c_nationkey')} END AS region FROM customer WHERE c_nationkey <> 3)""",
    "carrier_dim": f"""SELECT carrier_code, carrier_name, website, {_CARRIER_SHA} AS row_hash FROM (
        SELECT 'T' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 6, '0') AS carrier_code, s_name AS carrier_name,
            CASE WHEN s_nationkey <> 7 THEN 'www.1.example.com' END AS website FROM supplier)""",
    "merge_moved_partition": f"""SELECT * EXCLUDE (old_hash), {_HEADER_SHA} AS row_hash FROM (
        SELECT * EXCLUDE (row_hash) REPLACE (CASE WHEN status = 'C' THEN pick_date + 40 ELSE pick_date END AS pick_date), row_hash AS old_hash FROM header)""",
    "merge_after_publish": _all("header"),
    "refresh_window": """SELECT "CodPickList", fk_data_sk, fk_empresa_sk, fk_cliente_sk, "StatusDocumento", "QtdSKU", CAST("QtdPecas" AS VARCHAR) AS "QtdPecas", row_hash
        FROM loaded_fact""",
    "downtime_intervals": """SELECT branch_id, min(stopped_at) AS stopped_at, max(resumed_at) AS resumed_at, count(*) AS records FROM (
        SELECT *, sum(CASE WHEN stopped_at <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY branch_id ORDER BY stopped_at, resumed_at ROWS UNBOUNDED PRECEDING) AS island
        FROM (SELECT *, max(resumed_at) OVER (PARTITION BY branch_id ORDER BY stopped_at, resumed_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
              FROM downtime WHERE pick_list_id = '0' AND stopped_at < resumed_at)) GROUP BY branch_id, island""",
    "scan_csv_bronze": _all("opkl"),
    "malformed_lines": f"""SELECT "AbsEntry", CAST(CASE n WHEN 9 THEN 15 WHEN 19 THEN 18 ELSE 17 END AS BIGINT) AS fields,
        CASE n WHEN 9 THEN array_to_string(f[1:15], ';') WHEN 19 THEN array_to_string(f, ';') || ';extra' END AS line
        FROM (SELECT *, CAST("AbsEntry" AS BIGINT) % 50 AS n, [{', '.join(f"""coalesce("{c}", '')""" for c in _RAW_HEADER)}] AS f FROM opkl)""",
    "stage_header": _all("header_staged"),
    "parse_dates": f"""SELECT "AbsEntry", "UpdateDate", {_ts('"PickDate"', _TS, '%Y-%m-%d')} AS pick_ts,
        {_ts('"PickDate"', _TS, '%Y-%m-%d', _BR)} AS pick_ts_any, {_ts('"U_DataPedido"', _TS)} AS ordered_at FROM opkl""",
    "clean_text": """SELECT "CardCode" AS customer_id, "UpdateDate" AS update_text, upper(trim("State1")) AS state, lower("E_Mail") AS email FROM ocrd2""",
    "repair_decimal": "SELECT pick_list_id, pick_line_id, updated_at, CAST(rel_quantity AS VARCHAR) AS rel_quantity, CAST(pick_quantity AS VARCHAR) AS pick_quantity FROM lines_staged",
    "extract_code": f"""SELECT "AbsEntry", "UpdateDate", {_code('"U_Filial"')} AS branch_code, {_code('"Status"')} AS no_digits FROM opkl""",
    "quarantine_report": f"""SELECT 'unreadable date' AS reject_reason, count(*) AS rejected, count(*) FILTER (WHERE try_strptime("PickDate", '{_BR}') IS NOT NULL)
        AS rescued_by_extra_format FROM opkl WHERE {_ts('"PickDate"', _TS, '%Y-%m-%d')} IS NULL""",
    "dedup_latest_header": "SELECT * EXCLUDE (row_hash) FROM header",
    "dedup_latest_line": "SELECT * EXCLUDE (row_hash) REPLACE (CAST(rel_quantity AS VARCHAR) AS rel_quantity, CAST(pick_quantity AS VARCHAR) AS pick_quantity) FROM lines",
    "dedup_latest_customer": "SELECT * EXCLUDE (row_hash) FROM customers2",
    "dedup_latest_product": "SELECT * EXCLUDE (row_hash) REPLACE (" + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _SIZES) + ") FROM products",
    "row_hash_header": "SELECT pick_list_id, row_hash FROM header",
    "row_hash_line": "SELECT pick_list_id, pick_line_id, row_hash FROM lines",
    "row_hash_product": "SELECT product_id AS nk_product_id, row_hash FROM products",
    "row_hash_versioned": f"SELECT customer_id, effective_start, {_versioned_sha(_CUSTOMER)} AS row_hash FROM customer_history",
    "calendar_dim": _all("order_days"),
    "calendar_join": "SELECT pick_list_id, pick_date, data_sk AS fk_data_sk FROM header LEFT JOIN days ON data = pick_date",
    "line_weight": 'SELECT pick_list_id, CAST("PesoBruto" AS VARCHAR) AS "PesoBruto" FROM line_totals',
    "lines_per_picklist": 'SELECT pick_list_id, "QtdSKU", CAST("QtdPecas" AS VARCHAR) AS "QtdPecas" FROM line_totals',
    "header_with_lines": """SELECT h.pick_list_id, pick_date, status, coalesce("QtdSKU", 0) AS "QtdSKU", CAST(coalesce("QtdPecas", 0) AS VARCHAR) AS "QtdPecas",
        CAST(coalesce("PesoBruto", 0) AS VARCHAR) AS "PesoBruto" FROM header h LEFT JOIN line_totals t ON h.pick_list_id = t.pick_list_id""",
    "sla_seconds": "SELECT pick_list_id, CAST(epoch(pronto_conferencia) - epoch(em_separacao) AS BIGINT) AS sla_segundos FROM header",
    "changed_customers": "SELECT s.* FROM customers2 s LEFT JOIN customers1 t ON s.customer_id = t.customer_id WHERE t.customer_id IS NULL OR t.row_hash <> s.row_hash",
    "upsert_hash_guarded": _hash_upsert("customers1", "customers2", ["customer_id"], ["customer_id", *_CUSTOMER, "src_ts", "row_hash"]),
    "upsert_composite_key": _hash_upsert("stored_lines", "new_lines", ["pick_list_id", "pick_line_id"],
        ["pick_list_id", "pick_line_id", "order_id", "item_code", "rel_quantity", "pick_quantity", "updated_at", "row_hash"], ["rel_quantity", "pick_quantity"]),
    "upsert_insert_only": f"""SELECT * REPLACE (CASE WHEN data <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < TIMESTAMP '{SECOND_LOAD}')
        THEN 'stored' ELSE nome_dia END AS nome_dia) FROM order_days""",
    "upsert_unconditional": f"""SELECT empresa_sk, {', '.join(_COMPANY)} FROM companies WHERE is_current
        UNION ALL SELECT 0, 0, 'Desconhecida', 0, '_UNKNOWN_', 'Desconhecida', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Desconhecido'""",
    "surrogate_keys": "SELECT 1000 + row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id, customer_name FROM customers2",
    "unknown_member": f"""SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id AS nk_product_id, product_name, category_id, sales_unit, buy_unit,
        {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _SIZES)}, barcode, is_active, created_at, row_hash FROM products
        UNION ALL SELECT (SELECT count(*) + 1 FROM products), '_UNKNOWN_', 'Desconhecido', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, sha256('_UNKNOWN_')""",
    "scd2_customer": _all("customer_history"),
    "scd2_branch": _all("branch_history"),
    "scd2_late_reject": _all("customer_history"),
    "current_dimension": f"""SELECT customer_sk, customer_id AS nk_customer_id, {', '.join(_CUSTOMER)}, effective_start, effective_end, {_versioned_sha(_CUSTOMER)} AS row_hash
        FROM customer_history WHERE is_current
        UNION ALL SELECT 0, '_UNKNOWN_', 'Desconhecido', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TIMESTAMP '1900-01-01', {_END}, sha256('_UNKNOWN_')""",
    "current_branch_dimension": f"""SELECT branch_sk, branch_id AS nk_branch_id, {', '.join(_BRANCH)}, effective_start, effective_end, {_versioned_sha(_BRANCH)} AS row_hash
        FROM branch_history WHERE is_current
        UNION ALL SELECT 0, '_UNKNOWN_', 'Desconhecida', NULL, NULL, NULL, NULL, TIMESTAMP '1900-01-01', {_END}, sha256('_UNKNOWN_')""",
    "sync_history": _all("customer_history"),
    "sync_history_hash_only": f"SELECT * REPLACE ({_END} AS effective_end, TRUE AS is_current) FROM branch_history",
    "map_supervisor": f"SELECT customer_id, src_ts, state, {_supervisor('state')} AS supervisor FROM customers_staged2",
    "map_cost_center": f"SELECT pick_list_id, {_cost_center(_code('branch_id'))} AS centro_de_custo FROM header",
    "map_branch_size": f"SELECT pick_list_id, {_size(_code('branch_id'))} AS porte FROM header",
    "branch_enrichment": _all("companies"),
    "branch_hours": f"""{_opening('is_current')}
        UNION ALL SELECT '_UNKNOWN_', 'Desconhecida', {', '.join(f"TIMESTAMP '{t}'" for t in (_OPEN | {"hora_primeiro_pedido": _NINE, "hora_ultimo_pedido": _SIX}).values())}, FALSE, 'Desconhecido'""",
    "full_refresh": _opening("is_current"),
    "asof_customer_sk": f"SELECT h.pick_list_id, h.pick_date, coalesce(c.customer_sk, 0) AS customer_sk FROM header h LEFT JOIN customer_history c ON {_asof('c', 'customer_id')}",
    "asof_branch_sk": f"SELECT h.pick_list_id, h.pick_date, coalesce(e.empresa_sk, 0) AS empresa_sk, e.supervisor FROM header h LEFT JOIN companies e ON {_asof('e', 'branch_id')}",
    "fact_picklists": _all("fact", _FACT_DECIMALS),
    "fact_upsert": f"""SELECT * REPLACE (CAST("PesoBruto" AS VARCHAR) AS "PesoBruto", CAST("QtdPecas" AS VARCHAR) AS "QtdPecas") FROM (
        SELECT l.* FROM late_fact l LEFT JOIN early_fact e ON l."CodPickList" = e."CodPickList" WHERE e."CodPickList" IS NULL OR e.row_hash <> l.row_hash
        UNION ALL SELECT e.* FROM early_fact e LEFT JOIN late_fact l ON l."CodPickList" = e."CodPickList"
        WHERE l."CodPickList" IS NULL OR e.row_hash = l.row_hash)""",
    "fact_partition_counts": 'SELECT fk_data_sk, count(*) AS picklists, CAST(sum("QtdPecas") AS VARCHAR) AS pieces FROM fact GROUP BY fk_data_sk',
    "dq_duplicates": "SELECT pick_list_id, pick_line_id, count(*) AS copies FROM lines_staged GROUP BY pick_list_id, pick_line_id HAVING count(*) > 1",
    "dq_header": _checks("silver.opkl_clean", _header_checks("header")),
    "dq_header_raw": _checks("silver.opkl_clean", _header_checks("header_staged", "customer_id")),
    "dq_fact": _checks("gold.fact_picklists", _FACT_CHECKS),
    "dq_scd_customer": _checks("silver.dim_cliente_scd", _only(_history_checks("customer_history", "customer_id"), _FIVE)),
    "dq_scd_branch": _checks("silver.dim_empresas", _only(_history_checks("companies", "cod_filial"), _THREE)),
    "dq_scd_late": _checks("silver.dim_cliente_scd", _only(_history_checks("late_history", "customer_id"), _FIVE)),
    "dq_scd_overlap": "SELECT " + ", ".join(f"CAST(({_history_checks('intervals', 'nk')[c]}) AS BIGINT) AS {c}" for c in ("scd_overlap", "scd_bad_range", "scd_multi_curr")),
    "dq_scd_gap": "SELECT " + ", ".join(f"CAST(({_history_checks('intervals', 'nk')[c]}) AS BIGINT) AS {c}" for c in ("scd_gap", "scd_missing_hash", "scd_curr_bad_end")),
    "dq_report": _REPORT,
    "dq_totals": f"SELECT table_name, CAST(sum(violations) AS BIGINT) AS violations, sum(violations) >= 1 AS breached FROM ({_REPORT}) GROUP BY table_name",
    "sla_by_branch": _separation("Filial"),
    "sla_by_day": _separation("DataPickList"),
    "sla_rollup": """SELECT * FROM (WITH timed AS (SELECT "Filial" AS f, CAST(date_trunc('month', "DataPickList") AS DATE) AS m, sla_segundos AS s FROM fact WHERE sla_segundos IS NOT NULL),
        levels AS (SELECT 'branch and month' AS level, f, m, s FROM timed UNION ALL SELECT 'branch', f, NULL, s FROM timed UNION ALL SELECT 'month', NULL, m, s FROM timed),
        sorted AS (SELECT level, f, m, count(*) AS n, list_sort(list(s)) AS v FROM levels GROUP BY level, f, m),
        picked AS (SELECT *, v[CAST(floor(0.5 * (n - 1)) AS BIGINT) + 1] AS a, v[CAST(floor(0.9 * (n - 1)) AS BIGINT) + 1] AS b, ln(1.01 / 0.99) AS g FROM sorted)
        SELECT level, f AS "Filial", m AS period, n AS picklists,
            CAST(round(CASE WHEN a = 0 THEN 0 ELSE sign(a) * 2 * exp(ceil(ln(abs(a)) / g) * g) / (1 + exp(g)) END) AS BIGINT) AS p50_seconds,
            CAST(round(CASE WHEN b = 0 THEN 0 ELSE sign(b) * 2 * exp(ceil(ln(abs(b)) / g) * g) / (1 + exp(g)) END) AS BIGINT) AS p90_seconds FROM picked)""",
    "sla_breach_rate": f"""SELECT "Supervisor", count(*) AS picklists, count(*) FILTER (WHERE sla_segundos > {SLA_TARGET}) AS late,
        CAST(count(*) FILTER (WHERE sla_segundos > {SLA_TARGET}) AS DOUBLE) / count(*) AS breach_rate FROM fact WHERE sla_segundos IS NOT NULL GROUP BY "Supervisor\"""",
    "operator_productivity": """SELECT "IdSeparador" AS operator, CAST("EmSeparacao" AS DATE) AS day, count(DISTINCT "CodPickList") AS picklists,
        CAST(coalesce(sum(pick_quantity), 0) AS VARCHAR) AS pieces, count(DISTINCT item_code) AS items
        FROM fact LEFT JOIN lines ON "CodPickList" = pick_list_id WHERE "IdSeparador" IS NOT NULL AND "EmSeparacao" IS NOT NULL GROUP BY 1, 2""",
    "backlog": f"""SELECT "Filial", CASE WHEN age <= 1 THEN '0-1' WHEN age <= 7 THEN '2-7' WHEN age <= 30 THEN '8-30' ELSE '31+' END AS age_band,
        count(*) AS picklists, CAST(sum("QtdPecas") AS VARCHAR) AS pieces
        FROM (SELECT *, date_diff('day', CAST("DataPickList" AS DATE), DATE '{BACKLOG_DAY}') AS age FROM fact)
        WHERE "Cancelado" <> 'Y' AND "ProntoParaConferencia" IS NULL AND "Saida" IS NULL GROUP BY 1, 2""",
    "downtime_by_reason": """SELECT reason, count(*) AS stops, count(DISTINCT branch_id) AS branches,
        CAST(sum(date_diff('minute', stopped_at, resumed_at)) AS BIGINT) AS total_minutes, max(date_diff('minute', stopped_at, resumed_at)) AS longest_minutes
        FROM downtime GROUP BY reason""",
    "exclude_downtime": """SELECT "CodPickList", "Filial", sla_segundos FROM fact f
        WHERE NOT EXISTS (SELECT 1 FROM downtime x WHERE x.pick_list_id = f."CodPickList")
          AND NOT EXISTS (SELECT 1 FROM downtime x WHERE x.pick_list_id = '0' AND x.branch_id = f."Filial" AND f."EmSeparacao" < f."ProntoParaConferencia"
              AND f."EmSeparacao" < x.resumed_at AND x.stopped_at < f."ProntoParaConferencia" AND x.stopped_at < x.resumed_at)""",
    "incremental_window": f"""SELECT pick_list_id, status, update_date FROM header_staged
        WHERE update_date >= TIMESTAMP '{SECOND_LOAD}' - INTERVAL 35 DAY AND update_date <= TIMESTAMP '{SECOND_LOAD}'""",
    "stream_upsert_header": _all("header"),
    "stream_late_files": _all("header"),
    "stream_keyed_state": _all("header"),
    "skewed_lookup": """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, n AS orders_of_status
FROM orders LEFT JOIN (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1) ON nullif(o_orderstatus, 'P') = s""",
    "skewed_asof": """WITH l AS (SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day, count(*) OVER (PARTITION BY l_returnflag, year(l_shipdate)) AS lines_of_year FROM lineitem)
SELECT flag, lines_of_year, count(*) AS rows, min(day) AS first_day, max(day) AS last_day FROM l GROUP BY flag, lines_of_year""",
}


def _needed(sql: str) -> str:
    """The CTEs a select needs, in definition order."""
    def mentions(text: str) -> set[str]:
        words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
        return words & _CTES.keys()
    wanted, queue = set(), [sql]
    while queue:
        for name in mentions(queue.pop()) - wanted:
            wanted.add(name)
            queue.append(_CTES[name])
    ctes = ",\n".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in wanted)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def oracle_sql() -> dict[str, str]:
    return {name: _needed(sql) for name, sql in _SELECTS.items()}
