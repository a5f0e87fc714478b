"""Sources and sinks: Parquet layers, typed reads, documents, audit log, test-data adapter."""

from larder.sources import audit, documents, io, testdata  # noqa: F401
