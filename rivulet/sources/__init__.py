from .files import ingest_files, read_files, remove_sources, stream_files
from .sql import run_sql_script, sql_rows, sql_scalar, truncate_tables
from .tables import KeyedTable, TableConflict, table_exists
