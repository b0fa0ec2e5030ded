"""Record, table and ledger schemas."""

from pyspark.sql import types as T

# The raw record's fields, the silver/target columns in order, and the
# run ledger's columns and status words.
RAW_RECORD = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("dividend", T.DoubleType()),
    T.StructField("distr_freq", T.StringType()),
    T.StructField("payment_date", T.StringType()),
    T.StructField("record_date", T.StringType()),
    T.StructField("declaration_date", T.StringType()),
])

SILVER = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("market_dt", T.DateType()),
    T.StructField("dividend_ratio", T.DoubleType()),
    T.StructField("distr_freq", T.StringType()),
    T.StructField("payment_dt", T.DateType()),
    T.StructField("record_dt", T.DateType()),
    T.StructField("declar_dt", T.DateType()),
])

LEDGER = T.StructType([
    T.StructField("data_cat", T.StringType()),
    T.StructField("batch_dt", T.DateType()),
    T.StructField("start_dt", T.DateType()),
    T.StructField("end_dt", T.DateType()),
    T.StructField("extract_status", T.StringType()),
    T.StructField("transform_status", T.StringType()),
    T.StructField("load_status", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
])

WAITING = "WAITING"

CORRUPT = "_corrupt_record"


def envelope_schema(record: T.StructType, field: str = "data") -> T.StructType:
    """Schema of a raw JSON document; unparsable documents land in ``_corrupt_record``."""
    return T.StructType([
        T.StructField(field, T.ArrayType(record)),
        T.StructField(CORRUPT, T.StringType()),
    ])
