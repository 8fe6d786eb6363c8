from .bindings import requests_ev, requests_ord, table  # noqa: F401
from .tickets import (  # noqa: F401
    export_results, load_table, read_clean, read_raw, row_count, run_sql,
    write_table, write_with_count,
)
