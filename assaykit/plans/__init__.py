"""The jobs from raw files to the wide label dataset."""

from assaykit.plans.convert import (
    convert_item_keys,
    convert_item_table,
    convert_normal_columns,
    convert_result_column,
    convert_unit_column,
)
from assaykit.plans.export import export_labels, verify_export
from assaykit.plans.filter import filter_by_cohort
from assaykit.plans.load import load_parquet
from assaykit.plans.profile import profile_datasets
from assaykit.plans.split import split_by_item

__all__ = [
    "convert_item_keys",
    "convert_item_table",
    "convert_normal_columns",
    "convert_result_column",
    "convert_unit_column",
    "export_labels",
    "filter_by_cohort",
    "load_parquet",
    "profile_datasets",
    "split_by_item",
    "verify_export",
]
