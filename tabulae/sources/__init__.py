from tabulae.sources.delimited import csv_to_parquet, scan_delimited, scan_header_csv  # noqa: F401
from tabulae.sources.files import file_name, list_files  # noqa: F401
