"""Constants of the deposit ETL. Fixed values, which results depend on."""

# Words that mean "no value" in text fields, compared in lower case.
NULL_TOKENS = ("", " ", "na", "n/a", "null", "none", "nan", "-999", "-9999")

# Header names of each registry field, in order of preference.
REGISTRY_ALIASES = {
    "record_id": ("dep_id", "record_id", "site_id", "id"),
    "site_name": ("name", "site_name", "deposit_name", "mine_name"),
    "development_status": ("dev_stat", "development_status", "status"),
    "source_url": ("url", "source_url", "mrds_url"),
    "latitude": ("latitude", "lat", "y"),
    "longitude": ("longitude", "lon", "long", "x"),
    "commodity_text": ("code_list", "commodities", "commodity_codes", "commod", "commod1"),
    "commod1": ("commod1", "commodity_1", "primary_commodity"),
    "commod2": ("commod2", "commodity_2", "secondary_commodity"),
    "tonnage": ("tonnage", "tons", "ore_tonnage"),
    "grade": ("grade", "ore_grade"),
}

# Commodity names at ingestion.
INGEST_COMMODITIES = {
    "ag": "silver", "al": "aluminum", "as": "arsenic", "au": "gold", "ba": "barite", "cu": "copper", "fe": "iron",
    "hg": "mercury", "mn": "manganese", "mo": "molybdenum", "pb": "lead", "ree": "rare earth elements",
    "rare earth": "rare earth elements", "rare earth element": "rare earth elements",
    "rare earth elements": "rare earth elements", "sb": "antimony", "sn": "tin", "u": "uranium", "w": "tungsten", "zn": "zinc",
}

# Commodity names at fusion; another, shorter list.
FUSION_COMMODITIES = {
    "ag": "silver", "au": "gold", "cu": "copper", "fe": "iron", "hg": "mercury", "nb": "niobium", "pb": "lead",
    "rare earth": "rare earth elements", "rare earth elements": "rare earth elements", "ree": "rare earth elements", "zn": "zinc",
}

# Attribute names of geology layers, in order of preference.
GEOLOGY_ALIASES = {
    "geologic_unit": ("UNIT_NAME", "UNITNAME", "UNIT_NAM", "NAME", "UNIT", "MAP_UNIT"),
    "geology_description": ("DESCRIPTION", "DESC", "UNIT_DESC"),
    "geologic_age_raw": ("AGE", "PERIOD", "ERA", "EON", "GEO_AGE"),
    "lithology_raw": ("LITHOLOGY", "LITH", "ROCKTYPE", "ROCK_TYPE", "TYPE"),
}

# Ages and rocks looked for in unit texts, the first found counts.
AGE_KEYWORDS = (
    "Holocene", "Pleistocene", "Quaternary", "Pliocene", "Miocene", "Oligocene", "Eocene", "Paleocene", "Tertiary",
    "Cretaceous", "Jurassic", "Triassic", "Permian", "Pennsylvanian", "Mississippian", "Devonian", "Silurian",
    "Ordovician", "Cambrian", "Paleozoic", "Mesozoic", "Cenozoic", "Proterozoic", "Archean", "Precambrian",
)
LITHOLOGY_KEYWORDS = (
    "alluvium", "basalt", "carbonate", "conglomerate", "dolomite", "gneiss", "granite", "limestone", "marble",
    "quartzite", "rhyolite", "sandstone", "schist", "shale", "slate", "tuff", "volcanic",
)

# Match thresholds and confidence weights.
NAME_THRESHOLD = 88.0
DISTANCE_THRESHOLD_KM = 50.0
DISTANCE_BONUS_KM = 50.0
SITE_SIMILARITY = 0.88
COORDINATE_DIGITS = 4
WEIGHT_COORDINATES, WEIGHT_COMMODITIES, WEIGHT_NAME, WEIGHT_REPEATED = 0.4, 0.3, 0.2, 0.1

# Display colours (RGBA) and columns.
COMMODITY_COLORS = {
    "gold": (218, 165, 32, 190), "silver": (190, 190, 200, 180), "copper": (184, 115, 51, 185), "lead": (100, 110, 130, 180),
    "zinc": (70, 130, 180, 180), "rare earth elements": (78, 121, 167, 190), "niobium": (126, 87, 194, 185),
}
DEFAULT_COLOR = (52, 152, 219, 165)
MAP_COLUMNS = ("site_name", "latitude", "longitude", "commodities", "lithology", "geologic_age", "geologic_unit")
PREVIEW_COLUMNS = (
    "record_id", "site_name", "latitude", "longitude", "commodities", "source", "confidence_score", "geologic_unit",
    "lithology", "geologic_age",
)
# Columns that a quality report asks for.
REQUIRED_COLUMNS = ("record_id", "site_name", "latitude", "longitude", "commodities", "source", "confidence_score", "source_url")
