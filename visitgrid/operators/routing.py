"""Which exported table goes to which folder and file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import table_file_name, table_file_name_col

# Candidate tables for the two summary results, best first, and the
# words that pick fields instead.
DOSE_TABLES = ("CTDI_Results", "CTDI_Doses", "ctdi_results", "ctdi_doses")
DOSE_WORDS = ("ctdi", "dose")
IMAGE_TABLES = ("IQ_Results", "Image_Quality", "iq_results", "image_quality")
IMAGE_WORDS = ("iq", "image", "quality")

# Parquet targets by exact table name and by a word in the name.
EXACT_TARGETS = {
    "tube_voltage_series": "tube_voltage",
    "sensitivity_profile": "slice_thickness_sensitivity_profile",
    "slice_thickness": "slice_thickness_slice_thickness",
    "tcm_verification": "tcm",
    "protocols": "protocols",
}
WORD_TARGETS = ("geometry", "noise")

# Text export table -> (folder, file).
TEXT_TARGETS = {
    "geometry_tube_voltage": ("buisspanning-geometrie", "Tube_Voltage"),
    "geometry_irradiated_slice_thickness": ("buisspanning-geometrie", "Geometry_Irradiated_Slice_Thickness"),
    "geometry_table_motion": ("buisspanning-geometrie", "Geometry_Table_Motion"),
    "geometry_overscan": ("buisspanning-geometrie", "Geometry_Overscan"),
    "IQ_location": ("Beeldkwaliteit", "Location"),
    "IQ_date": ("Beeldkwaliteit", "Date"),
    "IQ_resolution_numeric": ("Beeldkwaliteit", "Resolution_Numeric"),
    "IQ_resolution_visual": ("Beeldkwaliteit", "Resolution_Visual"),
    "IQ_sensitometry_measurements": ("Beeldkwaliteit", "Sensitometry_Measurements"),
    "IQ_uniformity": ("Beeldkwaliteit", "Uniformity"),
    "IQ_uniformity_summary": ("Beeldkwaliteit", "Uniformity_Summary"),
    "IQ_HU": ("Beeldkwaliteit", "HU"),
    "IQ_IT_date": ("Beeldkwaliteit_Iteratief", "Date_IT"),
    "IQ_IT_resolution_numeric_it": ("Beeldkwaliteit_Iteratief", "Resolution_Numeric_IT"),
    "IQ_IT_resolution_visual_it": ("Beeldkwaliteit_Iteratief", "Resolution_Visual_IT"),
    "IQ_IT_sensitometry_measurements": ("Beeldkwaliteit_Iteratief", "Sensitometry_Measurements_IT"),
    "IQ_IT_uniformity": ("Beeldkwaliteit_Iteratief", "Uniformity_IT"),
    "IQ_IT_uniformity_summary": ("Beeldkwaliteit_Iteratief", "Uniformity_Summary_IT"),
    "IQ_IT_HU": ("Beeldkwaliteit_Iteratief", "HU_IT"),
    "IQ_DS_sensitometry_measurements": ("Beeldkwaliteit_DS", "Sensitometry_Measurements_DS"),
    "IQ_DS_HU": ("Beeldkwaliteit_DS", "HU_DS"),
    "IQ_DS_uniformity": ("Beeldkwaliteit_DS", "Uniformity_DS"),
    "IQ_DS_uniformity_summary": ("Beeldkwaliteit_DS", "Uniformity_Summary_DS"),
    "IQ_DS_IT_sensitometry_measurements": ("Beeldkwaliteit_DS_Iteratief", "Sensitometry_Measurements_DS_IT"),
    "IQ_DS_IT_HU": ("Beeldkwaliteit_DS_Iteratief", "HU_DS_IT"),
    "IQ_DS_IT_uniformity": ("Beeldkwaliteit_DS_Iteratief", "Uniformity_DS_IT"),
    "IQ_DS_IT_uniformity_summary": ("Beeldkwaliteit_DS_Iteratief", "Uniformity_Summary_DS_IT"),
    "sensitivity_profile_measurements": ("Snededikte", "Sensitivity_Profile_Measurements"),
    "slice_thickness_measurements_1": ("Snededikte", "Slice_Thickness_Measurements_1"),
    "slice_thickness_measurements_2": ("Snededikte", "Slice_Thickness_Measurements_2"),
    "noise": ("Ruis Detectorrij", "Noise"),
    "ctdi_32_reproducibility": ("CTDI 32cm", "CTDI_32_Reproducibility"),
    "ctdi_32_kv": ("CTDI 32cm", "CTDI_32_KV"),
    "ctdi_32_collimation": ("CTDI 32cm", "CTDI_32_Collimation"),
    "ctdi_32_mas_standard": ("CTDI 32cm", "CTDI_32_MAS_Standard"),
    "ctdi_32_mas_iterative": ("CTDI 32cm", "CTDI_32_MAS_Iterative"),
    "ctdi_32_dual_source": ("CTDI 32cm", "CTDI_32_Dual_Source"),
    "ctdi_32_twin_beam": ("CTDI 32cm", "CTDI_32_Twin_Beam"),
    "ctdi_16_kv": ("CTDI 16cm", "CTDI_16_KV"),
    "ctdi_16_kv_deviation": ("CTDI 16cm", "CTDI_16_KV_Deviation"),
    "tcm_dikteobject": ("Buisstroommodulatie", "TCM_Dikteobject"),
    "system_protocols": ("protocollen", "System_Protocols"),
    "CTDI_Results": ("CTDI", "CTDI_Results"),
    "IQ_Results": ("Image_Quality", "IQ_Results"),
    "Extracted_Fields": ("Metadata", "Extracted_Fields"),
    "QAVisit": ("Metadata", "QAVisit"),
    "Extraction_Metadata": ("Metadata", "Extraction_Metadata"),
}
OTHER_TABLES_FOLDER = "Extracted_Tables"


def safe_folder(name: str) -> str:
    return name.translate(str.maketrans(" -/", "___"))


def text_target(table: str) -> tuple[str, str]:
    """(folder, file) of a table in the text export; unknown tables share a folder."""
    folder, file = TEXT_TARGETS.get(table, (OTHER_TABLES_FOLDER, table_file_name(table)))
    return safe_folder(folder), file


def text_target_cols(table: Column) -> tuple[Column, Column]:
    """Column form of :func:`text_target`."""
    folder, file = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for name, (where, stem) in TEXT_TARGETS.items():
        folder = folder.when(table == name, safe_folder(where))
        file = file.when(table == name, stem)
    return folder.otherwise(OTHER_TABLES_FOLDER), file.otherwise(table_file_name_col(table))


def parquet_targets(table: str) -> list[str]:
    """Extra Parquet targets of a table beside the generic one."""
    targets = [EXACT_TARGETS[table]] if table in EXACT_TARGETS else []
    return targets + [f"{word}_{table}" for word in WORD_TARGETS if word in table.lower()]


def parquet_targets_col(table: Column) -> Column:
    exact = F.when(F.lit(False), "")
    for name, target in EXACT_TARGETS.items():
        exact = exact.when(table == name, target)
    by_word = [F.when(F.lower(table).contains(w), F.concat(F.lit(f"{w}_"), table)) for w in WORD_TARGETS]
    return F.array_compact(F.array(exact, *by_word))


def first_available(tables: dict[str, DataFrame], candidates: Sequence[str]) -> DataFrame | None:
    """First candidate table that exists."""
    return next((tables[name] for name in candidates if name in tables), None)
