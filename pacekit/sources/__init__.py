"""Table loaders, adapters from the driver tables, file ingest and sinks."""
