"""Ticket schemas and the fixed domain dictionaries.

Explicit ``StructType`` for the raw and the clean ticket table: nothing is
inferred, so a column keeps its type from stage to stage.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("unique_key", T.LongType(), False),
    T.StructField("created_date", T.TimestampNTZType(), False),
    T.StructField("closed_date", T.TimestampNTZType(), True),
    T.StructField("complaint_type", T.StringType(), True),
    T.StructField("descriptor", T.StringType(), True),
    T.StructField("borough", T.StringType(), True),
    T.StructField("zip_code", T.IntegerType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("agency", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("resolution_description", T.StringType(), True),
])

CLEAN_ADDED = T.StructType([
    T.StructField("created_year", T.IntegerType(), True),
    T.StructField("created_month", T.IntegerType(), True),
    T.StructField("created_day", T.IntegerType(), True),
    T.StructField("created_weekday", T.StringType(), True),
    T.StructField("created_hour", T.IntegerType(), True),
    T.StructField("created_period", T.StringType(), True),
    T.StructField("response_time_hours", T.DoubleType(), True),
    T.StructField("response_time_days", T.DoubleType(), True),
    T.StructField("complaint_category", T.StringType(), True),
    T.StructField("is_weekend", T.BooleanType(), True),
    T.StructField("quarter", T.IntegerType(), True),
    T.StructField("is_business_hours", T.BooleanType(), True),
    T.StructField("is_priority", T.BooleanType(), True),
])

CLEAN = T.StructType(RAW.fields + CLEAN_ADDED.fields)

# Raw tickets as written to CSV: dates are text and re-parsed on read.
RAW_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if f.name.endswith("_date") else f.dataType, True)
    for f in RAW.fields
])

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Kept as plain text in their natural order.
# --------------------------------------------------------------------------

BOROUGH_TRANSLATION = {
    "MANHATTAN": "Manhattan",
    "BROOKLYN": "Brooklyn",
    "QUEENS": "Queens",
    "BRONX": "Bronx",
    "STATEN ISLAND": "Staten Island",
}

COMPLAINT_TYPE_TRANSLATION = {
    "Noise - Residential": "Ruído - Residencial",
    "Noise - Street/Sidewalk": "Ruído - Rua/Calçada",
    "Noise - Commercial": "Ruído - Comercial",
    "Heat/Hot Water": "Aquecimento/Água Quente",
    "PAINT/PLASTER": "Pintura/Reboco",
    "DOOR/WINDOW": "Porta/Janela",
    "APPLIANCE": "Eletrodomésticos",
    "PLUMBING": "Encanamento",
    "Street Condition": "Condição da Rua",
    "Street Light Condition": "Iluminação Pública",
    "Traffic Signal Condition": "Semáforo",
    "UNSANITARY CONDITION": "Condições Insalubres",
    "Dirty Conditions": "Condições de Sujeira",
    "Rodent": "Roedores",
    "Graffiti": "Pichação",
    "Blocked Driveway": "Garagem Bloqueada",
    "Illegal Parking": "Estacionamento Irregular",
    "Air Quality": "Qualidade do Ar",
    "Tree Care": "Cuidado com Árvores",
    "Dead/Dying Tree": "Árvore Morta/Morrendo",
    "Water System": "Sistema de Água",
    "Animal Abuse": "Maus-Tratos Animais",
}

STATUS_TRANSLATION = {
    "Open": "Aberto",
    "Closed": "Fechado",
    "In Progress": "Em Andamento",
    "Pending": "Pendente",
}

WEEKDAY_TRANSLATION = {
    "Monday": "Segunda-feira",
    "Tuesday": "Terça-feira",
    "Wednesday": "Quarta-feira",
    "Thursday": "Quinta-feira",
    "Friday": "Sexta-feira",
    "Saturday": "Sábado",
    "Sunday": "Domingo",
}

# English weekday names, Monday first (Python weekday 0..6).
WEEKDAYS_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Day periods: 6-12 morning, 12-18 afternoon, 18-24 evening, else night.
PERIOD_MORNING = "Manhã"
PERIOD_AFTERNOON = "Tarde"
PERIOD_EVENING = "Noite"
PERIOD_NIGHT = "Madrugada"

# Category roll-up over translated type names; anything else is DEFAULT_CATEGORY.
CATEGORY_MAPPING = {
    "Ruído": ["Ruído - Residencial", "Ruído - Rua/Calçada", "Ruído - Comercial"],
    "Habitação": ["Aquecimento/Água Quente", "Pintura/Reboco", "Porta/Janela",
                  "Eletrodomésticos", "Encanamento"],
    "Vias Públicas": ["Condição da Rua", "Iluminação Pública", "Semáforo"],
    "Saneamento": ["Condições Insalubres", "Condições de Sujeira", "Roedores", "Pichação"],
    "Estacionamento": ["Garagem Bloqueada", "Estacionamento Irregular"],
    "Meio Ambiente": ["Qualidade do Ar", "Cuidado com Árvores", "Árvore Morta/Morrendo"],
    "Água": ["Sistema de Água"],
    "Animais": ["Maus-Tratos Animais"],
    "Outros": [],
}
DEFAULT_CATEGORY = "Outros"

BOROUGH_ZIP_DEFAULTS = {
    "MANHATTAN": 10001,
    "BROOKLYN": 11201,
    "QUEENS": 11101,
    "BRONX": 10451,
    "STATEN ISLAND": 10301,
}

PRIORITY_TYPES = ["Aquecimento/Água Quente", "Sistema de Água", "Condições Insalubres"]

PEAK_HOURS = [8, 9, 10, 17, 18, 19]
YEAR_END_MONTHS = [11, 12]

MONTH_LABELS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
                "Jul", "Ago", "Set", "Out", "Nov", "Dez"]

CLOSED_STATUSES = ["Closed", "Fechado"]

# Resolution buckets (days, inclusive upper bound) and their labels.
RESOLUTION_BUCKETS = [(1, "24h"), (2, "48h"), (7, "7d"), (30, "30d")]
RESOLUTION_OVERFLOW = "30d+"

# Scorecard grades, diagnostics labels and targets.
GRADE_EXCELLENT = "Excelente"
GRADE_GOOD = "Bom"
GRADE_FAIR = "Regular"
GRADE_CRITICAL = "Crítico"
URGENCY_HIGH = "Alta"
URGENCY_MEDIUM = "Média"
PROBLEM_LOW_RATE = "Taxa baixa"
PROBLEM_HIGH_TIME = "Tempo alto"
SYSTEM_EXCELLENT = "EXCELENTE"
SYSTEM_GOOD = "BOM"
SYSTEM_FAIR = "REGULAR"
SYSTEM_CRITICAL = "CRÍTICO"

# Model features: ten base columns, then the three engineered ones.
BASE_FEATURES = ["complaint_category", "borough", "created_hour", "created_weekday",
                 "created_month", "quarter", "is_weekend", "is_business_hours",
                 "is_priority", "created_period"]
ENGINEERED_FEATURES = ["borough_category", "is_peak_hour", "is_year_end"]
CATEGORICAL_FEATURES = ["complaint_category", "borough", "created_weekday",
                        "created_period", "borough_category"]
BOOLEAN_FEATURES = ["is_weekend", "is_business_hours", "is_priority",
                    "is_peak_hour", "is_year_end"]
