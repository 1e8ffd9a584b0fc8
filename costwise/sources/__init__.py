"""Input tables: the parquet loader and the ledger/BOM views derived from the driver tables."""
