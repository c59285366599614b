"""Column lists, types and code tables of the occurrence warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The occurrence feed's column names, in feed order.
OCCURRENCE_COLUMNS = (
    "id DISTRITO TIPO ANO AREAPOV AREAMATO AREAAGRIC AREATOTAL REACENDIMENTOS QUEIMADA "
    "FALSOALARME FOGACHO INCENDIO AGRICOLA NCCO NOMECCO DATAALERTA HORAALERTA LOCAL CONCELHO "
    "FREGUESIA FONTEALERTA INE X Y DIA MES HORA OPERADOR PERIMETRO APS CAUSA TIPOCAUSA DHINICIO "
    "DHFIM DURACAO HAHORA DATAEXTINCAO HORAEXTINCAO DATA1INTERVENCAO HORA1INTERVENCAO QUEIMA LAT "
    "LON CAUSAFAMILIA TEMPERATURA HUMIDADERELATIVA VENTOINTENSIDADE VENTOINTENSIDADE_VETOR "
    "VENTODIRECAO_VETOR PRECEPITACAO FFMC DMC DC ISI BUI FWI DSR THC MODFARSITE ALTITUDEMEDIA "
    "DECLIVEMEDIO HORASEXPOSICAOMEDIA DENDIDADERV COSN5VARIEDADE AREAMANCHAMODFARSITE "
    "AREASFICHEIROS_GNR AREASFICHEIROS_GTF FICHEIROIMAGEM_GNR AREASFICHEIROSHP_GTF "
    "AREASFICHEIROSHPXML_GTF AREASFICHEIRODBF_GTF AREASFICHEIROPRJ_GTF AREASFICHEIROSBN_GTF "
    "AREASFICHEIROSBX_GTF AREASFICHEIROSHX_GTF AREASFICHEIROZIP_SAA"
).split()

# Which feed columns are not text once typed.
INT_COLUMNS = (
    "ANO REACENDIMENTOS QUEIMADA FALSOALARME FOGACHO INCENDIO AGRICOLA DIA MES HORA QUEIMA"
).split()
BIGINT_COLUMNS = ["NCCO"]
DOUBLE_COLUMNS = (
    "AREAPOV AREAMATO AREAAGRIC AREATOTAL INE X Y CAUSA DURACAO HAHORA LAT LON TEMPERATURA "
    "HUMIDADERELATIVA VENTOINTENSIDADE VENTOINTENSIDADE_VETOR VENTODIRECAO_VETOR PRECEPITACAO "
    "FFMC DMC DC ISI BUI FWI DSR MODFARSITE ALTITUDEMEDIA DECLIVEMEDIO DENDIDADERV "
    "COSN5VARIEDADE AREAMANCHAMODFARSITE"
).split()

# The file columns that make up the list of perimeter files.
FILE_COLUMNS = (
    "AREASFICHEIROS_GNR AREASFICHEIROS_GTF AREASFICHEIROSHP_GTF AREASFICHEIROSHPXML_GTF "
    "AREASFICHEIRODBF_GTF AREASFICHEIROPRJ_GTF AREASFICHEIROSBN_GTF AREASFICHEIROSBX_GTF "
    "AREASFICHEIROSHX_GTF AREASFICHEIROZIP_SAA"
).split()

# Tokens read as missing (the feed's own four and the common text-reader defaults).
NA_TOKENS = [
    "", "NA", "NULL", "-",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NaN", "None", "n/a", "nan", "null",
]

# Upper-cased spellings of a true false-alarm flag.
TRUE_FLAGS = ["1", "SIM", "TRUE", "YES", "S", "Y", "T"]
FALSE_FLAGS = ["0", "NAO", "NÃO", "FALSE", "NO", "N", "F"]

HECTARE_M2 = 10000.0  # Fixed value: raw areas are hectares, the fact holds square metres.
MIN_DISPLAY_AREA = 10.0  # Fixed value: dashboards show fires above this many square metres.
PRECIPITATION_SENTINEL = 1.734723e-15  # Fixed value: stands for "not measured".
SIXTY_DAYS_MS = 60 * 24 * 60 * 60 * 1000.0  # Fixed value: upper limit of a plausible duration.
NO_DATA_MARKER = "Sistema sem dados!..."  # Fixed value: body of an empty reply.

# Raw label -> code, one "label | code" per line.
CAUSE_CODES = """
indeterminadas | UNDETERMINED
acidentais - outros | ACCIDENTAL_OTHERS
acidentais - maquinaria | ACCIDENTAL_MACHINERY
acidentais - transportes e comunicações | ACCIDENTAL_TRANSPORT_COMMUNICATION
incendiarismo - imputáveis | ARSON_IMPUTABLE
incendiarismo - sem motivação conhecida | ARSON_UNKNOWN_MOTIVATION
incendiarismo - inimputáveis | ARSON_UNIMPUTABLE
queimadas de sobrantes florestais ou agrícolas | FIRE_USE_EXTENSIVE_BURN_FOREST_AND_AGRICULTURAL
queimadas para gestão de pasto para gado | FIRE_USE_EXTENSIVE_BURN_PASTURE_MANAGEMENT
uso do fogo - fogueiras | FIRE_USE_BONFIRE
uso do fogo - lançamento foguetes | FIRE_USE_FIREWORK
uso do fogo - fumar | FIRE_USE_SMOKING
uso do fogo - queima de lixo | FIRE_USE_WASTE_BURNING_GARBAGE
queimas amontoados de sobrantes florestais ou agrícolas | FIRE_USE_WASTE_BURNING_FOREST_AND_AGRICULTURAL
uso do fogo - outros | FIRE_USE_OTHERS
reacendimentos | REKINDLE
estruturais - uso do solo | STRUCTURAL_LAND_USE
estruturais - outras | STRUCTURAL_OTHERS
estruturais - caça e vida selvagem | STRUCTURAL_HUNTING_AND_WILDLIFE
naturais | NATURAL
"""
FIRE_TYPE_CODES = """
queima | WASTE_BURNING
agrícola | AGRICULTURAL
florestal | FOREST
"""
CAUSE_TYPE_CODES = """
natural | NATURAL
desconhecida | UNKNOWN
intencional | DELIBERATE
reacendimento | REKINDLE
negligente | NEGLIGENT
"""
ALARM_SOURCE_CODES = """
vig. aérea | AIR_SURVEILLANCE
outros | OTHERS
gnr | GNR
psp | PSP
cdos | CDOS
cm | CM
pj | PJ
codu | CODU
populares | POPULATION
vt | VT
vmt/agris | VMT_AGRIS
pnpg | PNPG
cngf | CNGF
particular | PRIVATE
dra | DRA
part | PART
s.m.prot. civil | CIVIL_PROTECTION
sapadores | PROFESSIONAL_FIREFIGHTERS
sapadores flo | PROFESSIONAL_FOREST_FIREFIGHTERS
bav | BAV
cco | CCO
bt | BT
p.mun. | P_MUN
cb | CB
vig. movel terr | GROUND_MOBILE_SURVEILLANCE
112 | EMERGENCY_TELEPHONE_NR
117 | FIRE_EMERGENCY_TELEPHONE_NR
pv | PV
brisa | BRISA
pnm | PNM
"""

CODE_TABLES = {
    "cause": CAUSE_CODES,
    "fire_type": FIRE_TYPE_CODES,
    "cause_type": CAUSE_TYPE_CODES,
    "alarm_source": ALARM_SOURCE_CODES,
}

# dimension -> the feed column that carries its raw label
DIMENSION_LABELS = {
    "alarm_source": "FONTEALERTA",
    "fire_type": "TIPO",
    "cause": "CAUSAFAMILIA",
    "cause_type": "TIPOCAUSA",
}


def parse_codes(text: str) -> dict[str, str]:
    """Turn a "label | code" block into a mapping."""
    rows = (line.split(" | ") for line in text.strip().splitlines())
    return {label.strip(): code.strip() for label, code in rows}


def code_table(spark: SparkSession, dimension: str) -> DataFrame:
    """`raw_name, code` of one dimension; at most a few dozen rows by construction."""
    rows = list(parse_codes(CODE_TABLES[dimension]).items())
    return spark.createDataFrame(rows, "raw_name string, code string")


def occurrence_schema() -> T.StructType:
    """All-text schema of a landed occurrence file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in OCCURRENCE_COLUMNS])


def typed_columns() -> dict[str, str]:
    """Feed column -> SQL type after typing."""
    types = {c: "string" for c in OCCURRENCE_COLUMNS}
    types.update({c: "int" for c in INT_COLUMNS})
    types.update({c: "bigint" for c in BIGINT_COLUMNS})
    types.update({c: "double" for c in DOUBLE_COLUMNS})
    return types


# One boundary or perimeter part: rings of vertices, first ring outer, the others holes.
RINGS = T.ArrayType(T.ArrayType(T.StructType([
    T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
])))

WEATHER_RESPONSE = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_min", T.ArrayType(T.DoubleType())),
    ])),
])

WEATHER_DETAIL = (
    "incident_id string, source_file string, date date, lat double, lon double, "
    "temp_max double, temp_min double"
)
WEATHER_SUMMARY = (
    "source_file string, incident_id string, start_date date, end_date date, "
    "mean_temp_max double, mean_temp_min double, n_days bigint, lat double, lon double"
)
