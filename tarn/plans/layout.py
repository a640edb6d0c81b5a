"""The lake's one subject as configuration: columns, keys and dictionaries.

Nothing below is used inside an operator; the jobs pass it in.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, table names and descriptions of the stored tables.

BRONZE_COLUMNS = [
    "id",
    "name",
    "brewery_type",
    "address_1",
    "address_2",
    "address_3",
    "city",
    "state_province",
    "postal_code",
    "country",
    "longitude",
    "latitude",
    "phone",
    "website_url",
    "state",
    "street",
]
COORDINATES = ["longitude", "latitude"]

SILVER_KEYS = ["country", "state"]
SILVER_TABLE = "silver_breweries"
SILVER_STAMPS = ["ref_partition", "ts_proc", "ts_proc_partition"]

GOLD_KEYS = ["brewery_type", "city", "state_province", "country"]
GOLD_COUNT = "brewery_count"
GOLD_TABLE = "gold_breweries"
GOLD_STAMPS = ["ref_partition", "ts_proc"]

SILVER_DICTIONARY = [
    ("ref", "Referência da data de processamento no formato YYYYMMDD."),
    ("ref_partition", "Referência do ano/mês da partição no formato YYYYMM."),
    ("ts_proc", "Timestamp de processamento do job Spark."),
    ("ts_proc_partition", "Timestamp de processamento para partição."),
    ("id", "Identificador único da cervejaria (UUID). Convertido para STRING com TRIM."),
    ("name", "Nome da cervejaria. Convertido para STRING com TRIM."),
    ("brewery_type", "Tipo da cervejaria. Convertido para STRING com TRIM."),
    ("address_1", "Linha principal do endereço. Convertido para STRING com TRIM."),
    ("address_2", "Segunda linha do endereço (pode ser nulo). Convertido para STRING com TRIM."),
    ("address_3", "Terceira linha do endereço (pode ser nulo). Convertido para STRING com TRIM."),
    ("city", "Nome da cidade. Convertido para STRING com TRIM."),
    ("state_province", "Estado ou província. Convertido para STRING com TRIM."),
    ("postal_code", "CEP ou código postal. Convertido para STRING com TRIM."),
    ("country", "Nome do país. Convertido para STRING com TRIM."),
    ("longitude", "Coordenada geográfica de longitude. Convertido para DOUBLE."),
    ("latitude", "Coordenada geográfica de latitude. Convertido para DOUBLE."),
    ("phone", "Número de telefone de contato. Convertido para STRING com TRIM."),
    ("website_url", "URL do site da cervejaria. Convertido para STRING com TRIM."),
    ("state", "Nome do estado. Convertido para STRING com TRIM."),
    ("street", "Endereço da rua. Convertido para STRING com TRIM."),
]

GOLD_DICTIONARY = [
    (
        "brewery_type",
        "Tipo da cervejaria (micro, nano, regional, brewpub, large, planning, bar, contract, proprietor, closed).",
    ),
    ("city", "Nome da cidade onde estão localizadas as cervejarias contadas."),
    ("state_province", "Estado ou província onde estão localizadas as cervejarias contadas."),
    ("country", "País onde estão localizadas as cervejarias contadas."),
    ("brewery_count", "Quantidade de cervejarias agrupadas por tipo e localização."),
    ("ts_proc", "Timestamp de processamento do job Spark que gerou o registro."),
    ("ref_partition", "Referência do ano/mês de processamento no formato YYYYMM."),
]

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("ref", T.IntegerType()),
        T.StructField("ref_partition", T.IntegerType()),
        T.StructField("ts_proc", T.LongType()),
        T.StructField("ts_proc_partition", T.LongType()),
    ]
    + [
        T.StructField(name, T.DoubleType() if name in COORDINATES else T.StringType())
        for name in BRONZE_COLUMNS
    ]
)

GOLD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in GOLD_KEYS]
    + [
        T.StructField(GOLD_COUNT, T.LongType()),
        T.StructField("ts_proc", T.LongType()),
        T.StructField("ref_partition", T.IntegerType()),
    ]
)
