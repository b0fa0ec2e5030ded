from tidewell.sources.batches import batch_location, load_staging, read_batch, read_batches, read_table_or_none
from tidewell.sources.documents import decode_documents, encode_documents, record_types, schema_drift
from tidewell.sources.envelopes import read_envelopes, read_landed
from tidewell.sources.lineage import path_lineage, read_with_lineage

__all__ = [
    "batch_location", "decode_documents", "encode_documents", "load_staging", "path_lineage", "read_batch", "read_batches",
    "read_envelopes", "read_landed", "read_table_or_none", "read_with_lineage", "record_types", "schema_drift",
]
