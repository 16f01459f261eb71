"""Defaults of the operators' parameters."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values ----------------------------------------------------------------
# Codes and bounds that results depend on; each is a default that a caller may replace.

FIRST_SURVEY_DATE = "1999-01-11"
LAST_SURVEY_DATE = "2021-12-31"
EXCLUDED_SOURCES = (36, 71, 77, 97, 98, 99)
SURVEY_TYPES = (1, 2)
FOCAL_SPECIES = (
    39, 197, 242, 268, 270, 277, 278, 282, 306, 334, 382, 385, 386, 466, 470, 475, 488, 493, 506, 513, 526, 529, 542,
    555, 582, 583, 598, 620, 631, 638, 652, 670, 697, 710, 967,
)
MAIN_RANGE = 1
ORIGINAL_PERMUTATION = "original"
REPORTING_RATE = 3
CLASSIFIED_UNIT_TYPE = 3
COUNT_VARIABLE = 2
OTHER_VARIABLE = 1
COUNT_SOURCES = (178, 179, 184, 187, 188, 189, 191, 192, 193, 293)
PRIOR_SOURCE = 23
POINT_SRID = 4283
PRIOR_YEAR_AFTER = 1998
CUT_YEAR = 2018
MEAN_YEARS_BEFORE = 2019
WIDE_YEARS = range(1999, 2022)
EDITION_WIDE_YEARS = range(1999, 2019)
SIMPLIFY_TOLERANCE = 0.001
VALUE_DECIMALS = 4
SITE_DESIGN = 1
INCIDENTAL_SEARCH = 6
FAILING_STATUSES = (0, 1, 7)
FAILING_AGREEMENTS = (0,)
FAILING_STANDARDISATION = (0, 1)
FAILING_CONSISTENCY = (0, 1)
CLASS_OF_GROUP = {"Birds": "Aves", "Mammals": "Mammalia"}
NO_MANAGEMENT = "No known management"
NO_MANAGEMENT_CATEGORY = "Unknown"
# stands for an unknown value in a packed series
UNKNOWN_VALUE = "NA"
# ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class SurveyScope:
    """Which surveys count: dates inclusive, sources left out, survey types kept."""

    start: str = FIRST_SURVEY_DATE
    end: str = LAST_SURVEY_DATE
    excluded_sources: tuple[int, ...] = EXCLUDED_SOURCES
    survey_types: tuple[int, ...] | None = SURVEY_TYPES
