"""Fixed values. They must equal the business's own for results to match."""

# --- Fixed values: sentinels -------------------------------------------------------
UNKNOWN_KEY = "_UNKNOWN_"
UNKNOWN_NAME_M = "Desconhecido"
UNKNOWN_NAME_F = "Desconhecida"
UNKNOWN_SK = 0
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN_START = "1900-01-01 00:00:00"
HASH_SEPARATOR = "||"

# --- Fixed values: text formats ----------------------------------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
BRAZILIAN_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"

# --- Fixed values: branch lookups --------------------------------------------------
SUPERVISOR_STATES = {
    "Roberto Carlos": ["AC", "AP", "AM", "PA", "RO", "RR", "TO", "AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Mariana Silva": ["DF", "GO", "MT", "MS"],
    "Thiago Mendes": ["ES", "MG", "RJ", "SP"],
    "Beatriz Souza": ["PR", "RS", "SC"],
}
NO_SUPERVISOR = "Não Atribuído"
COST_CENTERS = {
    1: "9301", 3: "9104", 4: "9105", 5: "9106", 6: "9001", 7: "9002", 8: "9003", 9: "9005",
    11: "9006", 12: "9201", 13: "9202", 14: "9203", 15: "9204", 17: "9304", 18: "9305",
    19: "9302", 20: "9304", 21: "9004", 22: "9103", 23: "9101", 24: "9102", 25: "9205",
}
NO_COST_CENTER = "Ajustar"
LARGE_BRANCHES = [1, 9]
SMALL_BRANCHES = [12, 18, 22]
LARGE, MEDIUM, SMALL = "Grande", "Média", "Pequena"

# --- Fixed values: opening hours, as clock times on the spreadsheet epoch day ---------
OPENING_HOURS = {
    "hora_inicio": "1899-12-30 09:00:00",
    "hora_primeiro_pedido": "1899-12-30 09:30:00",
    "hora_almoco_inicio": "1899-12-30 12:00:00",
    "hora_almoco_fim": "1899-12-30 13:00:00",
    "hora_ultimo_pedido": "1899-12-30 17:30:00",
    "hora_fim": "1899-12-30 18:00:00",
    "total_hora_de_trabalho_sem_almoco": "1899-12-30 09:00:00",
    "total_hora_de_trabalho_com_almoco": "1899-12-30 08:00:00",
}
UNKNOWN_OPENING_HOURS = {
    **OPENING_HOURS,
    "hora_primeiro_pedido": "1899-12-30 09:00:00",
    "hora_ultimo_pedido": "1899-12-30 18:00:00",
}

# --- Fixed values: calendar names (Portuguese) ----------------------------------------
MONTH_NAMES = ["janeiro", "fevereiro", "março", "abril", "maio", "junho",
               "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]
MONTH_ABBREVIATIONS = ["jan", "fev", "mar", "abr", "mai", "jun",
                       "jul", "ago", "set", "out", "nov", "dez"]
WEEKDAY_NAMES = ["segunda", "terça", "quarta", "quinta", "sexta", "sábado", "domingo"]
CALENDAR_START, CALENDAR_END = "2020-01-01", "2030-12-31"

# --- Fixed values: picklist fact --------------------------------------------------------
FACT_HORIZON = "2026-01-01"
STOCK_TYPE = "M"
FREIGHT_TYPE = "9"
RULE_CONSIDER = "Considerar"
CANCELLED, PENDING, DISPATCHED = "C", "P", "E"

# --- Fixed values: quality and extraction --------------------------------------------
ALERT_THRESHOLD = 1
INCREMENTAL_WINDOW_DAYS = 35
WHOLE_BRANCH_CODE = "0"
