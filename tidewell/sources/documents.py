"""Raw documents as a text column: decoded against a category's schema, and compared with it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.registry import Category
from tidewell.schemas import CORRUPT, envelope_schema


def decode_documents(rows: DataFrame, cat: Category, text: str = "value") -> DataFrame:
    """``rows`` with the document in ``text`` as the columns of the category's envelope. A text that is no JSON document stays whole in
    ``_corrupt_record`` and has NULL elsewhere, as does a NULL text, which is corrupt only in that it has nothing; a field
    of another type than the schema's makes its document corrupt."""
    schema = envelope_schema(cat.record, cat.envelope_field)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    decoded = rows.withColumn("_decoded", F.from_json(F.col(text), schema, options))
    return decoded.select(*[c for c in rows.columns if c != text], f"_decoded.{cat.envelope_field}", f"_decoded.{CORRUPT}")


def encode_documents(envelopes: DataFrame, cat: Category, into: str = "value") -> DataFrame:
    """The reverse: each envelope as one JSON text, NULL fields left out."""
    return envelopes.withColumn(into, F.to_json(F.struct(cat.envelope_field))).drop(cat.envelope_field)


def raw_fields(text: Column, field: str) -> Column:
    """The records of a document as they came, each a map of field name to VARIANT; NULL where the text is no such document."""
    return F.try_variant_get(F.try_parse_json(text), f"$.{field}", "array<map<string,variant>>")


def schema_drift(rows: DataFrame, cat: Category, by: Sequence[str], text: str = "value") -> DataFrame:
    """Per group of ``by``: its documents, those that do not decode, the fields its records have and the schema lacks (``added``), and
    those of the schema that no record has (``absent``), both sorted and comma-joined. A text is parsed once; documents of a group
    with the same fields are counted before anything else, so only distinct names are gathered."""
    known = F.array(*map(F.lit, cat.record.fieldNames()))
    parsed = rows.select(*by, raw_fields(F.col(text), cat.envelope_field).alias("_records"))
    names = F.sort_array(F.array_distinct(F.flatten(F.transform("_records", lambda r: F.map_keys(r)))))
    alike = parsed.select(*by, F.col("_records").isNull().alias("_bad"), names.alias("_names"))
    alike = alike.groupBy(*by, "_bad", "_names").agg(F.count("*").alias("_n"))
    # Outer, as a filter on the names would be pushed below the count and parse every text again.
    each = alike.select(*by, "_bad", "_n", F.posexplode_outer("_names").alias("_pos", "_name"))
    first = F.coalesce("_pos", F.lit(0)) == 0
    total = lambda which: F.coalesce(F.sum(F.when(which, F.col("_n"))), F.lit(0).cast("long"))
    seen = each.groupBy(*by).agg(
        total(first).alias("documents"), total(first & F.col("_bad")).alias("undecoded"), F.collect_set("_name").alias("_seen")
    )
    listed = lambda names: F.array_join(F.array_sort(names), ",")
    return seen.select(
        *by, "documents", "undecoded", listed(F.array_except("_seen", known)).alias("added"),
        listed(F.array_except(known, "_seen")).alias("absent"),
    )


def record_types(rows: DataFrame, cat: Category, by: Sequence[str], text: str = "value") -> DataFrame:
    """Per group of ``by`` the schema that its records have, merged over all of them."""
    whole = F.try_variant_get(F.try_parse_json(F.col(text)), f"$.{cat.envelope_field}", "array<variant>")
    return rows.select(*by, F.explode(whole).alias("_r")).groupBy(*by).agg(F.schema_of_variant_agg("_r").alias("schema"))
