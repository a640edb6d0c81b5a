"""Each query of ``tarn.plans.queries`` as SQL for DuckDB, over the same tables.

Written from the rules, not from the Spark plans: one ``COUNT(DISTINCT ...)``
per column for a profile, ``CASE`` for a cell, ``GROUP BY`` for a rollup.
"""

from __future__ import annotations

from tarn.plans import layout

# Columns of the profiled tables, with the type names Spark gives them.
TABLE_COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}

TEXT_COLUMNS = [c for c in layout.BRONZE_COLUMNS if c not in layout.COORDINATES]
STAMP_TYPES = [
    ("ref", "int"),
    ("ref_partition", "int"),
    ("ts_proc", "bigint"),
    ("ts_proc_partition", "bigint"),
]
SILVER_TYPES = STAMP_TYPES + [
    (c, "double" if c in layout.COORDINATES else "string") for c in layout.BRONZE_COLUMNS
]
GOLD_TYPES = [(c, "string") for c in layout.GOLD_KEYS] + [
    (layout.GOLD_COUNT, "bigint"),
    ("ts_proc", "bigint"),
    ("ref_partition", "int"),
]

SITE_RAW = """
    SELECT '  ' || c_custkey || ' ' AS id,
           ' ' || c_name AS name,
           c_mktsegment || '  ' AS brewery_type,
           CASE WHEN c_custkey % 9 = 0 THEN 'None'
                ELSE c_custkey || ' Main St, "B" ' END AS address_1,
           CASE WHEN c_custkey % 17 = 0 THEN 'line1' || chr(10) || 'line2' END AS address_2,
           CAST(NULL AS VARCHAR) AS address_3,
           CASE WHEN c_custkey % 7 = 0 THEN NULL
                ELSE ' City ' || (c_custkey % 40) END AS city,
           n_name AS state_province,
           lpad(CAST(c_custkey % 1000 AS VARCHAR), 5, '0') AS postal_code,
           CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE r_name END AS country,
           CASE WHEN c_custkey % 13 = 0 THEN 'bad'
                ELSE CAST(c_acctbal AS VARCHAR) END AS longitude,
           ' ' || (c_custkey % 90) || '.25 ' AS latitude,
           CASE WHEN c_custkey % 19 = 0 THEN '   ' END AS phone,
           chr(9) || 'http://' || c_custkey || '.example' || chr(160) || ' ' AS website_url,
           CASE WHEN c_custkey % 23 = 0 THEN '  ' ELSE n_name END AS state,
           n_name || '/' || r_name AS street,
           c_mktsegment AS segment
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""


def _bronze_cell(c: str) -> str:
    if c in layout.COORDINATES:
        return f"TRY_CAST({c} AS DOUBLE) AS {c}"
    return f"CASE WHEN {c} IS NULL OR {c} = 'None' THEN '' ELSE {c} END AS {c}"


def _blank_null(c: str) -> str:
    return c if c in layout.COORDINATES else f"NULLIF({c}, '') AS {c}"


def _silver_cell(c: str) -> str:
    if c in layout.COORDINATES:
        return f"TRY_CAST({c} AS DOUBLE) AS {c}"
    return f"trim({c}, ' ') AS {c}"


def _each(cell, extra: str = "") -> str:
    return ", ".join(cell(c) for c in layout.BRONZE_COLUMNS) + extra


BRONZE = f"SELECT {_each(_bronze_cell)}, segment FROM ({SITE_RAW})"
MONTH = f"SELECT {_each(_blank_null)}, segment FROM ({BRONZE})"


def _silver(source: str, ref: int = 20260115) -> str:
    return f"""SELECT CAST({ref} AS INTEGER) AS ref, CAST(202601 AS INTEGER) AS ref_partition,
        {ref}060000 AS ts_proc, {ref}060000 AS ts_proc_partition,
        {_each(_silver_cell)} FROM ({source})"""


def _read_back(silver: str) -> str:
    cells = ", ".join(
        f"NULLIF({c}, '') AS {c}" if c in layout.SILVER_KEYS else c for c, _ in SILVER_TYPES
    )
    return f"SELECT {cells} FROM ({silver})"


def _gold(silver: str) -> str:
    keys = ", ".join(layout.GOLD_KEYS)
    return f"""SELECT {keys}, COUNT(*) AS brewery_count, 20260115060000 AS ts_proc,
        CAST(202601 AS INTEGER) AS ref_partition FROM ({silver}) GROUP BY {keys}"""


def _profile(source: str, columns: list[tuple[str, str]]) -> str:
    rows = [
        f"""SELECT '{c}' AS coluna, '{kind}' AS tipo, COUNT(*) - COUNT({c}) AS qt_nulos,
            CAST(format('{{:.2f}}', CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 100)
                AS DOUBLE) AS percent_nulos,
            COUNT(DISTINCT {c})
                + CAST(MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)
                AS cardinalidade
        FROM source_rows"""
        for c, kind in columns
    ]
    return f"WITH source_rows AS ({source}) " + " UNION ALL ".join(rows)


def _catalogue(
    source: str,
    columns: list[tuple[str, str]],
    zone: str,
    table: str,
    entries: list[tuple[str, str]],
) -> str:
    values = ", ".join(f"('{name}', '{text}')" for name, text in entries)
    return f"""SELECT '{zone}' AS zona, '{table}' AS tabela, p.coluna, p.tipo, d.descricao,
        p.qt_nulos, p.percent_nulos, p.cardinalidade
        FROM ({_profile(source, columns)}) AS p
        LEFT JOIN (VALUES {values}) AS d(coluna, descricao) ON p.coluna = lower(d.coluna)"""


def _control(source: str, table: str, stamps: list[str]) -> str:
    names = ", ".join(stamps)
    return f"""SELECT '{table}' AS name_file, '{table}' AS name_file_partition, {names},
        COUNT(*) AS qtd_registros FROM ({source}) GROUP BY {names}"""


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(entry.split(" ", 1)) for entry in TABLE_COLUMNS[table].split(", ")]


def _run_stamps(table: str, key: str, moment: str) -> str:
    local = f"(({moment} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo')"
    return f"""SELECT {key},
        CAST(strftime({local}, '%Y%m%d%H%M%S') AS BIGINT) AS ts_proc,
        CAST(strftime({local}, '%Y%m%d') AS INTEGER) AS ref,
        CAST(strftime({local}, '%Y%m') AS INTEGER) AS ref_partition FROM {table}"""


SILVER = _silver(SITE_RAW)
GOLD = _gold(SILVER)
CHAIN_SILVER = _silver(MONTH)
CHAIN_GOLD = _gold(_read_back(CHAIN_SILVER))

CHAIN_CONTROL = f"""
    SELECT name_file, name_file_partition, ref_partition, ts_proc, ts_proc_partition,
           qtd_registros
    FROM ({_control(CHAIN_SILVER, layout.SILVER_TABLE, layout.SILVER_STAMPS)})
    UNION ALL
    SELECT name_file, name_file_partition, ref_partition, ts_proc, NULL, qtd_registros
    FROM ({_control(CHAIN_GOLD, layout.GOLD_TABLE, layout.GOLD_STAMPS)})"""
LANDED_DOCUMENTS = """
    SELECT CAST(doc_id AS VARCHAR) AS id,
           NULLIF(CASE WHEN text = 'None' THEN '' ELSE text END, '') AS name,
           NULLIF(lang, '') AS brewery_type, NULLIF(source, '') AS city,
           CAST(NULL AS VARCHAR) AS state, CAST(n_chars AS VARCHAR) AS n_chars
    FROM documents"""

ORACLES: dict[str, str] = {
    "bronze_normalize": BRONZE,
    "bronze_json_pages": SITE_RAW,
    "bronze_csv_roundtrip": f"""SELECT * REPLACE (CASE WHEN CAST(trim(id) AS BIGINT) % 2 = 1
        THEN segment END AS segment) FROM ({MONTH})""",
    "bronze_documents_roundtrip": LANDED_DOCUMENTS,
    "landing_retry": LANDED_DOCUMENTS,
    "silver_conform": SILVER,
    "silver_documents": """
        SELECT CAST(20260115 AS INTEGER) AS ref, CAST(202601 AS INTEGER) AS ref_partition,
               20260115060000 AS ts_proc, 20260115060000 AS ts_proc_partition,
               CAST(doc_id AS VARCHAR) AS id, trim(text, ' ') AS name,
               trim(lang, ' ') AS brewery_type, trim(source, ' ') AS city,
               CAST(n_chars AS DOUBLE) AS n_chars
        FROM documents""",
    "silver_partition_roundtrip": _read_back(SILVER),
    "gold_rollup": GOLD,
    "gold_preview": f"""SELECT * FROM ({GOLD}) ORDER BY brewery_count DESC,
        {", ".join(f"{key} ASC NULLS FIRST" for key in layout.GOLD_KEYS)} LIMIT 10""",
    "gold_write_roundtrip": GOLD,
    "sql_args_rollup": GOLD,
    "rollup_lineitem": """
        SELECT l_shipdate, l_returnflag, l_linestatus, COUNT(*) AS line_count
        FROM lineitem GROUP BY l_shipdate, l_returnflag, l_linestatus""",
    "profile_site": _profile(SILVER, SILVER_TYPES),
    "profile_approx": f"""SELECT coluna, tipo, qt_nulos, percent_nulos, TRUE AS near_exact
        FROM ({_profile("SELECT * FROM lineitem", _columns("lineitem"))})""",
    **{
        f"profile_{name}": _profile(f"SELECT * FROM {name}", _columns(name))
        for name in TABLE_COLUMNS
    },
    "profile_broken": f"""
        SELECT * FROM ({_profile("SELECT * FROM lineitem", _columns("lineitem"))})
        UNION ALL SELECT name, 'int', NULL, NULL, NULL
        FROM (VALUES ('l_broken'), ('l_flag_number')) AS failing(name)""",
    "metadata_silver": _catalogue(
        SILVER, SILVER_TYPES, "silver", layout.SILVER_TABLE, layout.SILVER_DICTIONARY
    ),
    "metadata_gold": _catalogue(
        GOLD, GOLD_TYPES, "gold", layout.GOLD_TABLE, layout.GOLD_DICTIONARY
    ),
    "metadata_lineitem": _catalogue(
        "SELECT * FROM lineitem",
        _columns("lineitem"),
        "source",
        "lineitem",
        [("L_ORDERKEY", "order"), ("l_tax", "tax"), ("l_gone", "none")],
    ),
    "control_silver": _control(SILVER, layout.SILVER_TABLE, layout.SILVER_STAMPS),
    "control_gold": _control(GOLD, layout.GOLD_TABLE, layout.GOLD_STAMPS),
    "control_append": " UNION ALL ".join(
        _control(_silver(SITE_RAW, ref), layout.SILVER_TABLE, layout.SILVER_STAMPS)
        for ref in (20260115, 20260116)
    ),
    "layer_shape": f"""SELECT COUNT(*) AS qtd_linhas, CAST({len(SILVER_TYPES)} AS INTEGER)
        AS qtd_colunas FROM ({SILVER})""",
    "gate_outcomes": """
        SELECT 'lineitem' AS layer,
               CASE WHEN COUNT(*) > 0 THEN 'open' ELSE 'no rows in lineitem' END AS outcome
        FROM lineitem
        UNION ALL
        SELECT 'returned before sold',
               CASE WHEN COUNT(*) > 0 THEN 'open' ELSE 'no rows in returned before sold' END
        FROM lineitem WHERE l_quantity < 0
        UNION ALL
        SELECT 'not landed', 'no rows in not landed'""",
    "run_stamp_orders": _run_stamps("orders", "o_orderkey", "o_orderdate"),
    "run_stamp_events": _run_stamps("events", "event_id", "ts"),
    "chain_silver": _read_back(CHAIN_SILVER),
    "chain_gold": CHAIN_GOLD,
    "chain_catalogue": f"""
        SELECT * FROM ({_catalogue(
            CHAIN_SILVER, SILVER_TYPES, "silver", layout.SILVER_TABLE, layout.SILVER_DICTIONARY
        )})
        UNION ALL
        SELECT * FROM ({_catalogue(
            CHAIN_GOLD, GOLD_TYPES, "gold", layout.GOLD_TABLE, layout.GOLD_DICTIONARY
        )})""",
    "chain_control": CHAIN_CONTROL,
    "retry_gold": CHAIN_GOLD,
    "retry_control": CHAIN_CONTROL,
    "replaced_silver": _read_back(_silver(SITE_RAW, 20260116)),
}
