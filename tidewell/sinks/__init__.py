from tidewell.sinks.landing import land_batches, land_envelopes, split_documents, write_rejects
from tidewell.sinks.tables import replace_batch, replace_partitions, write_bucketed, write_clustered, write_partitioned

__all__ = [
    "land_batches", "land_envelopes", "replace_batch", "replace_partitions", "split_documents", "write_bucketed",
    "write_clustered", "write_partitioned", "write_rejects",
]
