"""Axial brain series with a brain window, from header attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops
from cohortloom.session import settle

# The attributes used.
TAGS = ["Image Type", "Accession Number", "Window Center", "Window Width"]


def select_series(tags: DataFrame) -> DataFrame:
    """``tags`` is the long table (file_path, Description, value). One row per kept folder.

    A folder with an unwanted word is dropped, unless its path extends a kept one.
    """
    wide = ops.pivot_unique(tags, "file_path", "Description", "value", TAGS)
    # Written down: the folder list and the rows looked up in it both come from here.
    axial = settle(wide.where(fn.contains_any(fn.quoted("Image Type"), ["AXIAL"])))
    folders = axial.select(fn.split_part("file_path", ("CT.", 0)).alias("folder"))
    brain = folders.where(fn.contains_none("folder", fixed.NOT_BRAIN_WORDS))
    kept = ops.prefix_semi(axial, "file_path", brain, "folder")
    kept = kept.withColumns(
        {
            "image_type_temp": fn.split_part("file_path", ("/random/", 1), ("/CT", 0)),
            "first_center_number": fn.first_of_list_literal(fn.quoted("Window Center")),
            "first_width_number": fn.first_of_list_literal(fn.quoted("Window Width")),
        }
    )
    in_window = [
        F.col("first_center_number") <= fixed.MAX_WINDOW_CENTER,
        F.col("first_width_number") <= fixed.MAX_WINDOW_WIDTH,
    ]
    return kept.where(fn.all_of(in_window))
