"""Names and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldloom.constants import CLASS_OF_GROUP


def taxonomic_class(group: Column) -> Column:
    """Class of a taxonomic group; empty text for any other group."""
    label = F.lit("")
    for name, klass in CLASS_OF_GROUP.items():
        label = F.when(group == name, klass).otherwise(label)
    return label


def group_label(group: Column, subgroup: Column) -> Column:
    """``group:subgroup``, or the group alone."""
    return F.concat(group, F.coalesce(F.concat(F.lit(":"), subgroup), F.lit("")))


def site_name(first: Column, second: Column, data_type: Column, site_id: Column, grid_cell_id: Column) -> Column:
    """The first known of two names, a label from type and site id, a label from the grid cell."""
    return F.coalesce(
        first,
        second,
        F.concat(F.lit("site_"), data_type.cast("string"), F.lit("_"), site_id.cast("string")),
        F.concat(F.lit("grid_"), grid_cell_id.cast("string")),
    )


def spatial_representativeness(suppressed: Column, hull_area: Column, core_area: Column) -> Column:
    """Hull area over core area at four decimals; NULL if suppressed for a taxon with a core area."""
    share = F.round(F.try_divide(hull_area, core_area), 4)
    return F.when(suppressed & (core_area != 0), F.lit(None).cast("double")).otherwise(share)
