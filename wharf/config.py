"""Names and options shared by the jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must match the upstream warehouse: topic names of the two inputs and the five
# traffic outputs, the source database kept by the change clean, the dimension namespace, and the
# change types that carry no row.
TOPIC_DB = "topic_db"
TOPIC_LOG = "topic_log"
TOPIC_DWD_TRAFFIC_START = "dwd_traffic_start"
TOPIC_DWD_TRAFFIC_ERR = "dwd_traffic_err"
TOPIC_DWD_TRAFFIC_PAGE = "dwd_traffic_page"
TOPIC_DWD_TRAFFIC_ACTION = "dwd_traffic_action"
TOPIC_DWD_TRAFFIC_DISPLAY = "dwd_traffic_display"
SOURCE_DATABASE = "gmall"
DIM_NAMESPACE = "gmall"
BOOTSTRAP_MARKERS = ("bootstrap-start", "bootstrap-complete")
DELETE_TYPE = "delete"
CONFIG_DELETE_OP = "d"

ROUTES = ("page", "start", "err", "display", "action")
ROUTE_TOPICS = {
    "page": TOPIC_DWD_TRAFFIC_PAGE,
    "start": TOPIC_DWD_TRAFFIC_START,
    "err": TOPIC_DWD_TRAFFIC_ERR,
    "display": TOPIC_DWD_TRAFFIC_DISPLAY,
    "action": TOPIC_DWD_TRAFFIC_ACTION,
}

DEFAULT_TZ = "Asia/Shanghai"


@dataclass(frozen=True)
class LogJobOptions:
    """Options of the log-split job.

    ``rule``: ``"later_day"`` repairs a ``1`` flag when the device was first seen on another day (the
    stated purpose); ``"same_day"`` repairs when it was first seen the same day (the code as written).
    ``flag_type``: ``"string"`` writes the repaired flag as ``"0"``; ``"int"`` writes the number 0.
    """

    tz: str = DEFAULT_TZ
    rule: str = "later_day"
    flag_type: str = "string"
    watermark: str | None = None  # e.g. "3 seconds"; assigned only, never used to drop rows


@dataclass(frozen=True)
class DimJobOptions:
    """Options of the dimension-sync job. ``null_cells``: ``"keep_old"`` or ``"overwrite"``."""

    database: str = SOURCE_DATABASE
    null_cells: str = "keep_old"


@dataclass(frozen=True)
class StreamOptions:
    """Trigger and rate settings (A3): 5 s interval by default; the limits bound a micro-batch, so that no
    start on a full topic takes all of it at once (the rest follows in the next batches)."""

    trigger_interval: str = "5 seconds"
    available_now: bool = False
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
