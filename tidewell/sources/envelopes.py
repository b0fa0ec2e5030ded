"""Raw JSON documents: ``{"data": [record, ...]}``."""

from pyspark.sql import DataFrame, SparkSession

from tidewell.registry import Category
from tidewell.schemas import CORRUPT, envelope_schema
from tidewell.sources.batches import read_batches


def json_options(multi_line: bool) -> dict[str, str]:
    return {
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def read_envelopes(spark: SparkSession, path: str, cat: Category, multi_line: bool = False) -> DataFrame:
    """Documents under ``path`` with an explicit schema: no inference pass, and the columns do
    not depend on what one week's data happens to hold.

    A document that does not parse keeps its text in ``_corrupt_record``; take such rows out with
    ``split_documents``. ``multi_line`` reads indented documents, one per file. Such a file is
    read by a single task; land one document per line where you can choose.
    """
    schema = envelope_schema(cat.record, cat.envelope_field)
    return spark.read.schema(schema).options(**json_options(multi_line)).json(path)


def read_landed(spark: SparkSession, root: str, cat: Category, first=None, last=None, multi_line: bool = False):
    """Landed documents of all batches, or of a span of them, with ``batch_dt``."""
    schema = envelope_schema(cat.record, cat.envelope_field)
    return read_batches(spark, root, schema, first, last, file_type="json", **json_options(multi_line))

