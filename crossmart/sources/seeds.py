"""Inline seeds: market geography, readable currency names, the base currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crossmart import schemas

# --- fixed values: the 45 markets (code, name, region, sub-region, lead currency) -----
GEOGRAPHY = """
US|United States|North America|Northern America|USD
CA|Canada|North America|Northern America|CAD
MX|Mexico|APLA|Latin America|MXN
CN|China (Mainland)|Greater China|Mainland China|CNY
TW|Taiwan|Greater China|Taiwan|TWD
JP|Japan|APLA|Japan|JPY
KR|South Korea|APLA|South Korea|KRW
SG|Singapore|APLA|Southeast Asia|SGD
TH|Thailand|APLA|Southeast Asia|THB
MY|Malaysia|APLA|Southeast Asia|MYR
ID|Indonesia|APLA|Southeast Asia|IDR
VN|Vietnam|APLA|Southeast Asia|VND
PH|Philippines|APLA|Southeast Asia|PHP
IN|India|APLA|South Asia|INR
AU|Australia|APLA|Oceania|AUD
NZ|New Zealand|APLA|Oceania|NZD
GB|United Kingdom|EMEA|Western Europe|GBP
IE|Ireland|EMEA|Western Europe|EUR
FR|France|EMEA|Western Europe|EUR
BE|Belgium|EMEA|Western Europe|EUR
NL|Netherlands|EMEA|Western Europe|EUR
LU|Luxembourg|EMEA|Western Europe|EUR
DE|Germany|EMEA|Western Europe|EUR
AT|Austria|EMEA|Western Europe|EUR
CH|Switzerland|EMEA|Western Europe|CHF
IT|Italy|EMEA|Southern Europe|EUR
ES|Spain|EMEA|Southern Europe|EUR
PT|Portugal|EMEA|Southern Europe|EUR
GR|Greece|EMEA|Southern Europe|EUR
SI|Slovenia|EMEA|Southern Europe|EUR
HR|Croatia|EMEA|Southern Europe|EUR
DK|Denmark|EMEA|Nordics|DKK
SE|Sweden|EMEA|Nordics|SEK
NO|Norway|EMEA|Nordics|NOK
FI|Finland|EMEA|Nordics|EUR
PL|Poland|EMEA|Central Europe|PLN
CZ|Czechia|EMEA|Central Europe|EUR
SK|Slovakia|EMEA|Central Europe|EUR
HU|Hungary|EMEA|Central Europe|EUR
RO|Romania|EMEA|Central Europe|RON
BG|Bulgaria|EMEA|Central Europe|EUR
TR|Turkey|EMEA|Middle East|TRY
IL|Israel|EMEA|Middle East|ILS
ZA|South Africa|EMEA|Africa|ZAR
EG|Egypt|EMEA|Africa|EGP
"""

# --- fixed values: readable currency names -------------------------------------------
CURRENCY_NAMES = """
USD|US Dollar
EUR|Euro
GBP|British Pound
JPY|Japanese Yen
CHF|Swiss Franc
CNY|Chinese Yuan
CAD|Canadian Dollar
AUD|Australian Dollar
NZD|New Zealand Dollar
SEK|Swedish Krona
NOK|Norwegian Krone
DKK|Danish Krone
RON|Romanian Leu
TRY|Turkish Lira
ILS|Israeli Shekel
ZAR|South African Rand
MXN|Mexican Peso
SGD|Singapore Dollar
THB|Thai Baht
MYR|Malaysian Ringgit
TWD|Taiwan Dollar
IDR|Indonesian Rupiah
VND|Vietnamese Dong
KRW|South Korean Won
PHP|Philippine Peso
INR|Indian Rupee
EGP|Egyptian Pound
BGN|Bulgarian Lev
"""

# --- fixed values: the base currency ---------------------------------------------------
BASE_CODE = "PLN"
BASE_NAME = "Polish zloty"
BASE_NAME_PL = "złoty polski"
# -----------------------------------------------------------------------------------------


def table_rows(text: str) -> list[tuple[str, ...]]:
    return [tuple(line.split("|")) for line in text.strip().splitlines()]


def inline_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A literal relation of known size, so the optimizer may fold or broadcast it."""
    def literal(value) -> str:
        if isinstance(value, int):
            return str(value)
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    quoted = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({columns})")


def geography(spark: SparkSession) -> DataFrame:
    """The market dimension, keys in listed order; its size is fixed by the list."""
    rows = [(i, *row) for i, row in enumerate(table_rows(GEOGRAPHY), start=1)]
    return inline_table(spark, rows, ", ".join(schemas.DIM_GEOGRAPHY.names))


def currency_names(spark: SparkSession) -> DataFrame:
    return inline_table(spark, table_rows(CURRENCY_NAMES), "currency_code, english")
