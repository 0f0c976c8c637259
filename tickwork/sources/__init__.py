"""Sources: candle CSV, activity Parquet, raw block files."""

from tickwork.sources.activity import align_activity, detect_time_column, load_activity
from tickwork.sources.blockfiles import read_block_files
from tickwork.sources.candles import land_candles, load_candles_csv, load_candles_parquet, normalize_candles
from tickwork.sources.ledger import list_table_files, new_files, read_reconciled, scan_new

__all__ = [
    "align_activity",
    "detect_time_column",
    "land_candles",
    "load_activity",
    "load_candles_csv",
    "load_candles_parquet",
    "list_table_files",
    "new_files",
    "normalize_candles",
    "read_block_files",
    "read_reconciled",
    "scan_new",
]
