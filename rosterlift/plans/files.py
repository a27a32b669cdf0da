"""Files of people and companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso
from ..functions.names import basename, file_extension, file_kind, file_path
from ..functions.predicates import has_file_type
from ..operators.joins import fk_map


def build_file_mapping(raw: DataFrame, owners: DataFrame, entity: str = "person",
                       types: Sequence[str] = ("pdf", "docx", "doc", "txt"), root: str = "people/") -> DataFrame:
    """raw: id, owner_id, folder, name, extension, added_at, and a label where the name does not tell the kind.

    Readable documents with their stored path.
    """
    rows = raw.where(has_file_type("extension", types))
    rows = fk_map(rows, "owner_id", owners, "atlas_id", f"atlas_{entity}_id", policy="exclude")
    return rows.select(
        F.col("owner_id").alias(f"{entity}_id"), f"atlas_{entity}_id", F.col("name").alias("actual_file_name"),
        file_kind("label" if "label" in raw.columns else "name").alias("type"),
        file_path("folder", F.col("id").cast("string"), "extension", root).alias("file_name"),
        iso("added_at").alias("created_at"))


def stored_files(raw: DataFrame) -> DataFrame:
    """raw: id, path. File name and extension read off the stored path."""
    return raw.select("id", "path", basename("path").alias("file_name"), file_extension("path").alias("ext"))
