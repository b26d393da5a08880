"""Declared schemas. Column order is part of the contract of the delimited datasets."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# The wide event log, partitioned by ``partition_date`` (kept a string, not a date).
EVENT_LOG = T.StructType(
    [
        T.StructField("ma_id", S),
        T.StructField("ma_type", S),
        T.StructField("system_name", S),
        T.StructField("facility_id", S),
        T.StructField("attribute_id", S),
        T.StructField("attribute_value", S),
        T.StructField("attribute_prior_value", S),
        T.StructField("reason", S),
        T.StructField("action", S),
        T.StructField("location", S),
        T.StructField("quantity", S),
        T.StructField("step_job_oid", T.LongType()),
        T.StructField("job_oid", T.LongType()),
        T.StructField("date_time_local", S),
        T.StructField("resource", S),
        T.StructField("role", S),
        T.StructField("event_action", S),
        T.StructField("event_type", S),
        T.StructField("partition_date", S),
    ]
)
EVENT_LOG_COLUMNS = tuple(EVENT_LOG.fieldNames())

# Nested test records of the archive job.
TTE = T.StructType(
    [
        T.StructField("summaryID", T.BinaryType()),
        T.StructField("summaryType", S),
        T.StructField("derivedLotID", S),
        T.StructField("serialNo", S),
        T.StructField("design", S),
        T.StructField("step", T.BinaryType()),
        T.StructField("facility", S),
        T.StructField("testFacility", S),
        T.StructField("version", S),
        T.StructField("standardFlow", S),
        T.StructField("ownerCompany", S),
        T.StructField("machineID", S),
        T.StructField("startEtime", S),
        T.StructField("endEtime", S),
        T.StructField(
            "cycleData",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("cycle", T.IntegerType()),
                        T.StructField("timestamp", T.LongType()),
                        T.StructField("data", S),
                    ]
                )
            ),
        ),
        T.StructField("attributes", T.MapType(S, S)),
    ]
)


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


VARIANCE_COLUMNS = (
    "LOT_ID", "STEP_ID", "DESIGN_ID", "PACKAGE_TYPE", "STEP_TEMPERATURE", "LEAD_COUNT",
    "PACKAGE_HEIGHT", "PACKAGE_LENGTH", "PACKAGE_WIDTH", "PRODUCT_FAMILY", "TESTER_ID",
    "LOT_QTY", "reason", "action", "quantity", "date_time_local", "ww", "partition_date",
)
TOTALLOT_COLUMNS = (
    "LOT_ID", "STEP_ID", "DESIGN_ID", "PACKAGE_TYPE", "PRODUCT_FAMILY", "TESTER_ID",
    "LOT_QTY", "date_time_local", "ww", "partition_date",
)
ARCHIVE_TOTALLOT_COLUMNS = (
    "LOT_ID", "STEP_ID", "PACKAGE_TYPE", "DESIGN_ID", "PRODUCT_FAMILY", "LOT_QTY",
    "date_time_local", "TESTER_ID", "ww", "partition_date",
)
ARCHIVE_VARIANCE_COLUMNS = (
    "LOT_ID", "STEP_ID", "PACKAGE_TYPE", "DESIGN_ID", "LEAD_COUNT", "PACKAGE_HEIGHT",
    "PACKAGE_LENGTH", "PACKAGE_WIDTH", "PRODUCT_FAMILY", "LOT_QTY", "reason", "action",
    "quantity", "date_time_local", "SPEED", "TEMPERATURE", "TESTER_ID", "ww", "partition_date",
)
# Weekly reports: the daily layouts with a dataset prefix; variance drops STEP_TEMPERATURE.
REPORT_TOTALLOT_COLUMNS = tuple("totallot_" + c for c in TOTALLOT_COLUMNS)
REPORT_VARIANCE_COLUMNS = tuple(
    "variance_" + c for c in VARIANCE_COLUMNS if c != "STEP_TEMPERATURE"
)

VARIANCE = strings(*VARIANCE_COLUMNS)
TOTALLOT = strings(*TOTALLOT_COLUMNS)
ARCHIVE_VARIANCE = strings(*ARCHIVE_VARIANCE_COLUMNS)
ARCHIVE_TOTALLOT = strings(*ARCHIVE_TOTALLOT_COLUMNS)
REPORT_VARIANCE = strings(*REPORT_VARIANCE_COLUMNS)
REPORT_TOTALLOT = strings(*REPORT_TOTALLOT_COLUMNS)

# The catalog's tables over the reports name the columns without the prefix.
REPORT_TABLE_VARIANCE = strings(*[c for c in VARIANCE_COLUMNS if c != "STEP_TEMPERATURE"])
REPORT_TABLE_TOTALLOT = TOTALLOT

DATASETS = {
    "variance": VARIANCE,
    "totallot": TOTALLOT,
    "archive_variance": ARCHIVE_VARIANCE,
    "archive_totallot": ARCHIVE_TOTALLOT,
}
