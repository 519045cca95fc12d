"""tessera: text and product-catalogue analytics expressed as Spark plans.

Sub-packages
------------
sources    table loaders, catalogue text scan and parser, fixture relations
functions  column expressions (tokeniser, byte hash bucket, parsing helpers)
operators  reusable DataFrame operators (top-k, per-group limits, upsert, ...)
sinks      writers (delimited part files, CSV, clustered query tables)
plans      composed questions and word-count jobs
streaming  incremental ingest of catalogue files with Structured Streaming
"""

from tessera.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
