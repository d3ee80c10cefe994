"""Readers (S1–S5) and writers (K1–K5); the only modules that touch paths."""

from reelscope.sources.readers import (conform, header_schema, read_catalog, read_catalog_csv,
                                       read_discussions, read_submissions)
from reelscope.sources.writers import (write_bucketed, write_catalog_csv, write_parquet,
                                       write_partitioned, write_shows)

__all__ = ["conform", "header_schema", "read_catalog", "read_catalog_csv", "read_discussions",
           "read_submissions", "write_bucketed", "write_catalog_csv", "write_parquet",
           "write_partitioned", "write_shows"]
