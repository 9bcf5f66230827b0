from .batches import fan_out, start, wait
from .files import (
    HourlyTable, WindowTable, batch_table, merged_table, preview, read_batches, read_replaced, replaced_table, top, write_lines,
)
from .jdbc import jdbc_sink, write_jdbc
from .kafka import publish

__all__ = [
    "HourlyTable", "WindowTable", "batch_table", "fan_out", "jdbc_sink", "merged_table", "preview", "publish", "read_batches",
    "read_replaced", "replaced_table", "start", "top", "wait", "write_jdbc", "write_lines",
]
