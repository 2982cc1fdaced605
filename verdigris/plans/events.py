"""Event attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.text import ends_with_any, presence_label
from verdigris.operators.joins import lookup
from verdigris.params import Params

# fixed values: columns of the attendance export
EXPORT_COLUMNS = {
    "Attendance Status": "status",
    "Attendee - First Name": "first_name",
    "Attendee - Last Name": "last_name",
    "Email (Temp)": "email",
    "Event Date": "event_date",
    "Event Name": "event",
    "Record ID#": "record_id",
}


def attendance_table(export: DataFrame) -> DataFrame:
    """Landed attendance rows; people without a name or address leave."""
    renamed = export.withColumnsRenamed(EXPORT_COLUMNS)
    return (
        renamed.withColumns(
            {
                "event_date": F.col("event_date").try_cast("timestamp"),
                "status": presence_label(F.col("status").try_cast("boolean")),
                "last_update": F.current_timestamp(),
            }
        )
        .dropna(subset=["first_name", "last_name", "email"])
        .select(*EXPORT_COLUMNS.values(), "last_update")
    )


def directory_table(directory: DataFrame) -> DataFrame:
    """Lower-case addresses; entries without a department or address leave."""
    return directory.withColumn("email", F.lower("email")).dropna(subset=["department_name", "email"])


def attendance_records(
    records: DataFrame, employees: DataFrame, students: DataFrame, params: Params = Params()
) -> DataFrame:
    """Attendees with department, student year and role."""
    staff = employees.select("email", F.col("department_name").alias("__staff"))
    pupils = students.select("email", F.col("department_name").alias("__pupil"), "student_year")
    joined = lookup(lookup(records, staff, "email"), pupils, "email")
    address, year = F.col("email"), F.col("student_year")
    role = (
        F.when(
            ends_with_any(address, [f"@{d}" for d in params.employee_domains]) & year.isNull(), F.lit("employee")
        )
        .when(ends_with_any(address, [f"@{d}" for d in params.alumni_domains]), F.lit("alumni"))
        .when(year.isNotNull(), F.lit("student"))
        .otherwise(F.lit("external"))
    )
    return joined.select(
        "record_id",
        "status",
        "first_name",
        "last_name",
        "email",
        "event_date",
        "event",
        F.coalesce("__staff", "__pupil").alias("department_name"),
        "student_year",
        role.alias("role"),
        "last_update",
    )


def role_summary(records: DataFrame) -> DataFrame:
    return records.groupBy("event", "event_date", "role").agg(F.count("*").alias("attendee_count"))


def department_summary(records: DataFrame) -> DataFrame:
    """Grouped by the stored department: a missing one and ``external`` stay apart."""
    counted = records.groupBy("event", "event_date", "department_name").agg(F.count("*").alias("attendee_count"))
    return counted.withColumn("department_name", F.coalesce("department_name", F.lit("external")))


def student_summary(records: DataFrame) -> DataFrame:
    students = records.filter(F.col("student_year").isNotNull())
    return students.groupBy("event", "event_date", "student_year").agg(F.count("*").alias("attendee_count"))
