"""Visits: attributes, reference lookups, ids, trace columns, validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import PLAIN_NUMBER_TEXT, as_int_or_null
from ..functions.names import unique
from ..functions.text import first_present, strip

# Field names in which an attribute may be found, best first.
TYPE_FIELDS = ("test_type", "type_test", "qa_visit.type_test")
DATE_FIELDS = ("test_date", "date_test", "visit_date", "qa_visit.date_test")
MEMBER_FIELDS = ("qa_member1", "qa_members")
PHYSICIAN_FIELDS = ("physiciens", "qa_visit.physiciens")
NUMBER_FIELDS = ("qampr", "QAMPR", "reference_QC", "qa_visit.reference_QC")
REFERENCE_FIELDS = ("reference_QC", "qa_visit.reference_QC")
HOSPITAL_FIELDS = ("hospital_id", "Hospital_ID", "centrum_nummer")
SYSTEM_FIELDS = ("system_id", "System_ID", "scanner.system_id", "system_nr", "system_number")

PHYSICIANS_TYPE = "array<struct<nom:string,riziv:string>>"


def field_value(fields: Column, names: Sequence[str]) -> Column:
    """First present value among field names in a ``map<string,string>``."""
    return first_present(*[F.try_element_at(fields, F.lit(n)) for n in names])


def visit_attributes(fields: Column, default_type: str | None = None) -> dict[str, Column]:
    """Type, test date and the two members, from a map of scalar fields.

    Members come from their own fields, else from the list of physicians.
    """
    doctors = F.from_json(field_value(fields, PHYSICIAN_FIELDS), PHYSICIANS_TYPE)

    def doctor(i: int) -> Column:
        return F.get(doctors, i)["nom"]

    return {
        "type": F.coalesce(field_value(fields, TYPE_FIELDS), F.lit(default_type)),
        "date_test": field_value(fields, DATE_FIELDS),
        "qa_member1": F.coalesce(field_value(fields, MEMBER_FIELDS), doctor(0)),
        "qa_member2": F.coalesce(first_present(F.try_element_at(fields, F.lit("qa_member2"))), doctor(1)),
    }


def _number(text: Column) -> Column:
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.rlike(PLAIN_NUMBER_TEXT), trimmed.try_cast("double"))


def lookup_first(df: DataFrame, key: str, reference: DataFrame, ref_key: str, order: str, picks: Mapping[str, str]) -> DataFrame:
    """Left lookup on the numeric value of two keys; the first reference row in load
    order wins.

    The reference is reduced to one row per key by an aggregate, so the join cannot
    multiply rows.  No broadcast hint: its size grows with the data, and adaptive
    execution broadcasts it only after it has seen that it is small.
    """
    names = list(picks)
    right = (
        reference.withColumn("_key", _number(F.col(ref_key)))
        .where("_key is not null")
        .groupBy("_key")
        .agg(F.min_by(F.struct(*[F.col(picks[n]).alias(n) for n in names]), order).alias("_ref"))
    )
    left = df.withColumn("_key", _number(F.col(key)))
    return left.join(right, "_key", "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_ref").isNotNull().alias("_found"),
        *[as_int_or_null(F.col(f"_ref.{n}").cast("string")).alias(n) for n in names],
    )


def resolve_references(visits: DataFrame, linktable: DataFrame, systems: DataFrame, order: str) -> DataFrame:
    """Hospital, system and system-info ids by device number, with a status text."""
    linked = lookup_first(
        visits, "qampr", linktable, "Qampr", order, {"hospital_id": "Hospital_ID", "system_id": "System_ID"}
    ).withColumnRenamed("_found", "_linked")
    full = lookup_first(linked, "system_id", systems, "ID", order, {"system_info_id": "System_Info_ID"})
    status = (
        F.when(_number(F.col("qampr")).isNull(), "ReferenceResolutionSkipped")
        .when(~F.col("_linked"), "ReferenceResolutionNoMatch")
        .otherwise("ReferencesResolved")
    )
    return full.withColumn("resolution", status).drop("_linked", "_found")


def new_reference_rows(incoming: DataFrame, stored: DataFrame, key: str = "ID") -> DataFrame:
    """Rows whose id is not stored yet; repeats inside the new rows are kept."""
    return incoming.join(stored.select(key).distinct(), key, "left_anti").select(*incoming.columns)


def merged_reference(incoming: DataFrame, stored: DataFrame | None, key: str = "ID") -> DataFrame:
    """Stored table after an incremental load: append by id, else replace."""
    if stored is None or key not in incoming.columns or key not in stored.columns:
        return incoming
    return stored.unionByName(new_reference_rows(incoming, stored, key), allowMissingColumns=True)


# Export name of a trace column -> visit column.
TRACE = {"QAID": "qaid", "Qampr": "qampr", "Reference_QC": "reference_qc", "Source_File": "excel_file_name"}
BATCH_TRACE = ("QAID", "QAMPR", "source_file", "hospital_id", "system_id")


def add_trace(df: DataFrame, visits: DataFrame, key: str = "workbook_id") -> DataFrame:
    """Add the trace columns a table lacks; columns it has stay as they are."""
    missing = {name: source for name, source in TRACE.items() if name not in df.columns}
    if not missing:
        return df
    side = visits.select(F.col(key), *[F.col(source).alias(name) for name, source in missing.items()])
    return df.join(side, key, "left")


def add_batch_trace(df: DataFrame, visits: DataFrame, key: str = "workbook_id") -> DataFrame:
    """Overwrite the batch trace columns, after making column names unique."""
    named = df.toDF(*unique(df.columns))
    kept = named.drop(*[c for c in BATCH_TRACE if c != key])
    return kept.join(visits.select(key, *[c for c in BATCH_TRACE if c != key]), key, "left")


def with_validity(visits: DataFrame) -> DataFrame:
    """Validity flag (id, template and file name given) and a warning on the site id."""
    def given(name: str) -> Column:
        text = F.col(name).cast("string")
        return text.isNotNull() & (text != "") & (text != "0") if name == "qaid" else text.isNotNull() & (text != "")

    valid = given("qaid") & given("template_id") & given("excel_file_name")
    odd = (F.col("hospital_id") != 0) & (F.col("hospital_id") <= 0)
    return visits.withColumn("is_valid", valid).withColumn(
        "warning", F.when(valid & odd, F.concat(F.lit("invalid hospital id: "), F.col("hospital_id").cast("string")))
    )


def structure_check(workbooks: DataFrame, required_sheets: Sequence[str], required_tables: Sequence[str] = ()) -> DataFrame:
    """Missing sheets and tables per workbook (columns ``sheets`` and ``tables``)."""
    def lacking(required: Sequence[str], present: str) -> Column:
        wanted = F.array(*[F.lit(x) for x in required]).cast("array<string>")
        return F.array_except(wanted, F.col(present))

    out = workbooks.withColumn("missing_sheets", lacking(required_sheets, "sheets"))
    if "tables" in workbooks.columns:
        out = out.withColumn("missing_tables", lacking(required_tables, "tables"))
    return out.withColumn("structure_ok", F.size("missing_sheets") == 0)
