"""Schemas and fixed values of the people-flow tables and reports."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

LOCAL_TZ = "Asia/Taipei"

TRACKING = StructType(
    [
        StructField("camera_id", StringType()),
        StructField("frame_id", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("track_id", LongType()),
        *(StructField(c, DoubleType()) for c in ("x1", "y1", "x2", "y2")),
        StructField("frame_width", LongType()),
        StructField("frame_height", LongType()),
    ]
)
REQUIRED_TRACKING = ("frame_width", "frame_height")

ZONE_COUNTS = StructType(
    [
        StructField("camera_id", StringType()),
        StructField("zone", StringType()),
        StructField("time_bucket", TimestampType()),
        StructField("unique_visitors", LongType()),
        StructField("entries", LongType()),
    ]
)
LINE_COUNTS = StructType(
    [
        StructField("line_group", StringType()),
        StructField("camera_id", StringType()),
        StructField("line", StringType()),
        StructField("time_bucket", TimestampType()),
        StructField("in_count", LongType()),
        StructField("out_count", LongType()),
    ]
)

#: Band widths are given for frames this wide and scale with the frame.
BASE_WIDTH = 1920
DEFAULT_BAND = 25.0

# File names of the stages' contract.
TRACKING_FILE, ZONE_FILE, LINE_FILE, REPORT_FILE = "tracking_results.parquet", "zone_counts.parquet", "line_counts.parquet", "report.xlsx"

# Weekdays, meal reminders, sheets and their headers as reports show them.
WEEKDAYS = ("星期一", "星期二", "星期三", "星期四", "星期五", "星期六", "星期日")
MEALS = ((11, 14, "加強午餐動線"), (17, 20, "加強晚餐動線"))
NO_REMINDER = "無"
SHEETS = {
    "zone_hourly": ("各區域人流", ("日期", "星期", "小時", "區域", "人流量"), ("日期", "小時", "區域")),
    "zone_peak": ("各區域每日尖峰", ("日期", "星期", "區域", "尖峰時段", "尖峰人流", "每日提醒"), ("日期", "區域")),
    "line_hourly": ("各出入口人流", ("日期", "星期", "小時", "群組", "計數線", "進場人數", "出場人數", "淨進出"), ("日期", "小時", "計數線")),
    "line_peak_in": ("各出入口每日進場尖峰", ("日期", "星期", "群組", "計數線", "尖峰時段", "尖峰進場", "尖峰出場", "每日提醒"), ("日期", "計數線")),
    "line_peak_out": ("各出入口每日出場尖峰", ("日期", "星期", "群組", "計數線", "尖峰時段", "尖峰進場", "尖峰出場", "每日提醒"), ("日期", "計數線")),
}
#: Headers only: another writer owns its rows.
EVENTS_SHEET = ("活動事件", ("日期", "星期", "開始時間", "結束時間", "區域", "活動名稱", "活動類型"))
COLUMN_WIDTH = 14
