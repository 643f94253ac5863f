"""Writers. Spark's committer publishes a folder only when its job succeeds, with ``_SUCCESS``."""
