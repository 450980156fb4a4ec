from dimstar.sources.catalog import SOURCE_COLUMNS, Sources, load_sources  # noqa: F401
