from riskframe.sources.io import (
    load_csv, load_parquet, read_table, save_parquet, save_report_csv,
    save_report_json,
)
from riskframe.sources.fixtures import applications, credit_view

__all__ = ["load_csv", "load_parquet", "read_table", "save_parquet",
           "save_report_csv", "save_report_json", "applications", "credit_view"]
