"""Sources (file discovery, workbook/HTML readers, CSV/JSON dimensions) and
the lake sink (layered Parquet with safe replace)."""
