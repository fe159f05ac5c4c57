"""Sources and sinks: CSV, JSON, Parquet and workbook collections."""

from .files import (CSVDestination, CSVSource, Destination, JSONArrayDestination,  # noqa: F401
                    JSONArraySource, JSONDestination, JSONSource, ParquetDestination, ParquetSource,
                    Source)
from .workbook import ExcelDestination, ExcelSource  # noqa: F401
