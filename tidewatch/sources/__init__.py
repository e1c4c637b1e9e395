from tidewatch.sources.tables import load_table, posts, TABLES  # noqa: F401
