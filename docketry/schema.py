"""Column roles of a case-record table, and the values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the request table.
CHANNEL_COLUMNS = (
    "PROVENANCE_TELEPHONE",
    "PROVENANCE_COURRIEL",
    "PROVENANCE_PERSONNE",
    "PROVENANCE_COURRIER",
    "PROVENANCE_TELECOPIEUR",
    "PROVENANCE_INSTANCE",
    "PROVENANCE_MOBILE",
    "PROVENANCE_MEDIASOCIAUX",
    "PROVENANCE_SITEINTERNET",
)
PLACE_COLUMNS = ("LOC_LONG", "LOC_LAT", "LOC_X", "LOC_Y", "LOC_ERREUR_GDT")
TEXT_COLUMNS = (
    "NATURE",
    "ACTI_NOM",
    "TYPE_LIEU_INTERV",
    "RUE",
    "RUE_INTERSECTION1",
    "RUE_INTERSECTION2",
    "ARRONDISSEMENT",
    "ARRONDISSEMENT_GEO",
    "LIN_CODE_POSTAL",
    "PROVENANCE_ORIGINALE",
    "UNITE_RESP_PARENT",
    "DERNIER_STATUT",
)
CATEGORY_FEATURES = (
    "TYPE_LIEU_INTERV",
    "ARRONDISSEMENT",
    "ARRONDISSEMENT_GEO",
    "UNITE_RESP_PARENT",
    "PROVENANCE_ORIGINALE",
)

# Folded label -> canonical label, and the folded closing states.
LABELS = {
    "information": "Information",
    "commentaire": "Commentaire",
    "requete": "Requete",
    "plainte": "Plainte",
}
CLOSED_STATES = ("termine", "refuse", "annule", "supprime")

# Strings a CSV scan reads as null.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Columns that cleaning derives.
CREATED = "creation_ts"
UPDATED = "last_status_ts"
TARGET = "NATURE_TARGET"
STATUS = "FINAL_STATUS_FOLDED"
DURATION = "resolution_time_days"
MONTH = "sample_month"
CALENDAR_FEATURES = ("creation_year", "creation_month", "creation_dayofweek", "creation_hour")
HAS_PLACE = "has_geo"
NUMBER_FEATURES = (*CALENDAR_FEATURES, HAS_PLACE)

# Default chronological split bounds.
TRAIN_END = "2020-12-31 23:59:59"
VALIDATION_END = "2021-06-30 23:59:59"


@dataclass(frozen=True)
class RecordSchema:
    """Which source column plays which role; any of them may be absent from a table."""

    label: str = "NATURE"
    text: str = "ACTI_NOM"
    status: str = "DERNIER_STATUT"
    created: str = "DDS_DATE_CREATION"
    updated: str = "DATE_DERNIER_STATUT"
    latitude: str = "LOC_LAT"
    longitude: str = "LOC_LONG"
    text_columns: tuple[str, ...] = TEXT_COLUMNS
    number_columns: tuple[str, ...] = CHANNEL_COLUMNS + PLACE_COLUMNS
    labels: dict[str, str] = field(default_factory=lambda: dict(LABELS))
    closed_states: tuple[str, ...] = CLOSED_STATES


@dataclass(frozen=True)
class FeatureColumns:
    """The explicit list of columns a model may read."""

    text: str | None = "ACTI_NOM"
    categories: tuple[str, ...] = CATEGORY_FEATURES
    numbers: tuple[str, ...] = NUMBER_FEATURES
