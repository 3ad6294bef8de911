"""Writers for the pipeline's outputs (archive, tables, topic)."""
