"""Writers: Parquet tables with row counts, and dashboard result sets."""
