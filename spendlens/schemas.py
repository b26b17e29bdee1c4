"""Schemas of the input tables, and the header names of the raw monthly files."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(28, 4)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_DATE, _TEXT, _INT, _LONG, _DOUBLE = (
    T.DateType(), T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType())

PAYMENTS = _struct(period=_DATE, province=_TEXT, category=_TEXT, payment_brand=_TEXT,
                   installments=_INT, operations=_LONG, amount=AMOUNT)
PLATFORM_SALES = _struct(period=_DATE, platform=_TEXT, province=_TEXT, category=_TEXT,
                         installments=_INT, operations=_LONG, amount=AMOUNT)
AGGREGATOR_SALES = _struct(period=_DATE, aggregator=_TEXT, province=_TEXT, category=_TEXT,
                           installments=_INT, operations=_LONG, amount=AMOUNT)
MERCHANT_SALES = _struct(period=_DATE, province=_TEXT, category=_TEXT, merchant_id=_LONG,
                         operations=_LONG, amount=AMOUNT)
MERCHANT_REGISTRY = _struct(merchant_id=_LONG, legal_name=_TEXT, province=_TEXT, locality=_TEXT,
                            address=_TEXT)
PRICE_INDEX = _struct(period=_DATE, index_level=_DOUBLE)
POPULATION = _struct(province=_TEXT, region=_TEXT, population=_LONG)
CATEGORY_LIST = _struct(category=_TEXT)

# Saved intermediates.
PLATFORM_WEIGHTS = _struct(period=_DATE, platform=_TEXT, category=_TEXT, installments=_INT,
                           operations=_LONG, amount=T.DecimalType(38, 4),
                           share_operations=_DOUBLE, share_amount=_DOUBLE)
FINAL_BASE = PAYMENTS
MERCHANT_HISTORY = _struct(merchant_id=_LONG, months=T.ArrayType(_INT), first_period=_DATE, last_period=_DATE,
                           number=_LONG)
MERCHANT_BITMAPS = _struct(period=_DATE, province=_TEXT, category=_TEXT, bucket=_LONG, keys=T.BinaryType())

INPUTS = {
    "payments": PAYMENTS,
    "platform_sales": PLATFORM_SALES,
    "aggregator_sales": AGGREGATOR_SALES,
    "merchant_sales": MERCHANT_SALES,
    "merchant_registry": MERCHANT_REGISTRY,
    "price_index": PRICE_INDEX,
    "population": POPULATION,
    "category_list": CATEGORY_LIST,
}

# Header names of the raw files and the column each one becomes.
HEADERS = {
    "anio": "year",
    "mes": "month",
    "periodo": "period",
    "provincia": "province",
    "region": "region",
    "poblacion": "population",
    "rubroa12": "category",
    "descrubroa12": "category",
    "marca_medio_pago": "payment_brand",
    "plataforma": "platform",
    "agrupador": "aggregator",
    "cuit": "merchant_id",
    "razon_social": "legal_name",
    "localidad": "locality",
    "direccion": "address",
    "cuotas": "installments",
    "operaciones": "operations",
    "monto": "amount",
    "ipc_indec_ng": "index_level",
}
