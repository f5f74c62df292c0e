"""Codes, lists and limits of the laboratory's reports."""

from dataclasses import dataclass, field

from creamline.operators.runtime_filter import BITS
from creamline.sources.shared import REPORTS, SharedTables

# Item and test codes, regions and measure names as the reports define them.

OFFICIAL_ITEMS = (
    "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVPG", "MVPQVPB", "MVPQVP8",
)
OFFICIAL_REPORT_TESTS = (
    "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVPG", "MVPQVPB", "MVQVP52A", "MVPQVP8",
    "MVQVP52B", "MVQVP41",
)
ALERT_TESTS = (
    "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVPG", "MVPQVPB", "MVQVP52A", "MVPQVP8",
    "MVQVP52B",
)
RED_TAG_TESTS = (
    "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVP9", "MVPQVPAb", "MVPQVPG", "MVPQVPB",
    "MVQVP52A",
)
AVERAGED_REGIONS = ("MN", "MO", "WI")
TECHNICIAN_PARAMETER = "UM0004ZH"
CELL_COUNT_PARAMETER = "JJ00047N"

OFFICIAL_MEASURES = (
    "Bacteria Count", "Delvo Inhibitor", "Somatic cells", "Freezing point", "Analysis Temperature",
)
COMPONENT_MEASURES = (
    "Fat", "Freezing point", "Lactose", "Milk Urea Nitrogen (MUN)", "Other Solids",
    "Solids not fat (SNF)", "Somatic cells", "True Protein",
)
BACTERIA_MEASURES = (
    "Bacteria Count", "Bacteria Count(PI)", "Coliforms", "Delvo Inhibitor", "Pregnancy",
    "Thermoduric Plate Count", "Alkylphenolethoxylates",
)
CULTURE_MEASURES = (
    "Alkylphenolethoxylates", "Gram negative Bacteria", "Staphylococcus aureus",
    "Staphylococcus species", "Streptococci agalactiae", "Streptococcus species",
    "Prototheca species", "Mycoplasma species", "Bulk Tank Coliforms",
)
INSPECTOR_MEASURES = ("Bacteria", "Delvo Inhibitor", "Somatic cells", "Freezing point")
INSPECTOR_WIDE_MEASURES = (
    "Bacteria", "Delvo Inhibitor", "Fat", "Freezing point", "Lactose", "Milk Urea Nitrogen (MUN)",
    "Other Solids", "Solids not fat (SNF)", "Somatic cells", "True Protein",
    "Pre-incubation Count (PI)",
)
FEED_MEASURES = (
    "Fat", "Freezing point", "Lactose", "Milk Urea Nitrogen (MUN)", "Other Solids",
    "Solids not fat (SNF)", "Somatic cells", "True Protein", "Bacteria",
    "Pre-incubation Count (PI)", "Coliforms", "Lab Pasteurized Count",
)
COUNT_MEASURES = ("Bacteria", "Somatic cells")
LEGACY_MEASURES = ("Bacteria Count", "Delvo Inhibitor", "Somatic cells", "Freezing point")

ALERT_LIMITS = {"Bacteria Count": 750, "Somatic Cells": 1000}


@dataclass(frozen=True)
class LabRules:
    """What a laboratory may want to change about the reports.

    ``lab_code`` is the laboratory's own short name, which goes into the goat client's record. ``shared``
    holds the lines of a report for its readers; with None each reader computes them again. ``filter_bits``
    is the size of the filter that cuts results in their scan: some 16 bits for each line of a report are
    good, fewer let results of other lines through to the joins.
    """

    status: str = "Completed"
    official_items: tuple[str, ...] = OFFICIAL_ITEMS
    averaged_regions: tuple[str, ...] = AVERAGED_REGIONS
    technician_parameter: str = TECHNICIAN_PARAMETER
    alert_region: str = "WI"
    feed_state: str | None = "IA"
    lab_code: str = "LAB"
    strict_numbers: bool = False
    shared: SharedTables | None = field(default=REPORTS, compare=False, repr=False)
    filter_bits: int = BITS


DEFAULT_RULES = LabRules()
