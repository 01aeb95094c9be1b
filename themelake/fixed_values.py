"""Fixed values.

Every literal here takes part in a result that users compare with what they
have today, so it is data rather than design: names, patterns, lists, formats.
"""

# --- themes and their output folders
THEME_DIRS = {
    "satelital": "satelital",
    "transporte": "transporte",
    "luz_nocturna": "luz_nocturna",
    "demografia": "demografia",
}

# --- areas of interest, lon lat, EPSG:4326
AOIS = {
    "peninsula": "POLYGON((-9.5 36.0, -9.5 43.8, 3.3 43.8, 3.3 36.0, -9.5 36.0))",
    "tiny": "POLYGON((0 0, 0 1, 1 1, 1 0, 0 0))",
    "madrid": "POLYGON((-3.9 40.2, -3.9 40.6, -3.3 40.6, -3.3 40.2, -3.9 40.2))",
}

# --- collections
SENTINEL_1 = "SENTINEL-1"
SENTINEL_2 = "SENTINEL-2"

# --- catalogue columns
LEAD_COLUMNS = [
    "Id", "Name", "ContentDate.Start", "ContentDate.End",
    "ContentType", "ContentLength", "OriginDate", "GeoFootprint",
]
SENTINEL_2_COLUMNS = [
    "Id", "Name", "identifier", "content_start", "IngestionDate", "cloudcover",
    "sizeInBytes", "footprint", "product_level", "s3_asset",
]
SENTINEL_1_COLUMNS = [
    "Id", "Name", "identifier", "content_start", "IngestionDate", "polarizations",
    "sizeInBytes", "footprint", "s3_asset",
]
ATTRIBUTE_VALUE_FIELDS = ["Value", "value", "doubleValue", "stringValue"]

# --- archive member globs by selection mode; {band} is one band name
ASSET_GLOBS = {
    "tci": [
        "*IMG_DATA*/R10m/*TCI*.jp2",
        "*IMG_DATA*/R20m/*TCI*.jp2",
        "*IMG_DATA*/R60m/*TCI*.jp2",
        "*IMG_DATA_R10m*/*TCI*.jp2",
        "*IMG_DATA_R20m*/*TCI*.jp2",
        "*IMG_DATA_R60m*/*TCI*.jp2",
        "*IMG_DATA*/*TCI*.jp2",
        "*/*TCI*.jp2",
    ],
    "scl": [
        "*IMG_DATA*/R20m/*SCL*.jp2",
        "*IMG_DATA_R20m*/*SCL*.jp2",
        "*IMG_DATA*/*SCL*.jp2",
        "*/*SCL*.jp2",
    ],
    "bands": [
        "*IMG_DATA*/R10m/*{band}*10m*.jp2",
        "*IMG_DATA*/R20m/*{band}*20m*.jp2",
        "*IMG_DATA*/R60m/*{band}*60m*.jp2",
        "*IMG_DATA_R10m*/*{band}*.jp2",
        "*IMG_DATA_R20m*/*{band}*.jp2",
        "*IMG_DATA_R60m*/*{band}*.jp2",
        "*IMG_DATA*/*{band}*.jp2",
        "*/*{band}*.jp2",
    ],
    "all": [
        "*IMG_DATA*/*.jp2",
        "*IMG_DATA*/*.tiff",
        "*/*PREVIEW*.jp2",
        "*manifest.safe",
        "*manifest.xml",
    ],
    "sentinel-1": [
        "*measurement/*.tiff",
        "*measurement/*.tif",
        "*manifest.safe",
        "*preview*.png",
        "*preview*.jpg",
    ],
}
STATUS_OK = "ok"
STATUS_NO_ID = "no-id"
STATUS_NO_MATCH = "no assets matched"

# --- stations: (element type, tag, value)
STATION_RULES = [
    ("node", "railway", "station"),
    ("node", "station", "rail"),
    ("way", "railway", "station"),
    ("relation", "railway", "station"),
]

# --- population
SEX_CATEGORIES = ["Total", "Hombres", "Mujeres"]
SEX_COLUMNS = {"Total": "total", "Hombres": "hombres", "Mujeres": "mujeres"}
SERIES_DEFAULTS = {"Nombre": "Desconocido", "CODPROV": "", "CODMUNI": ""}
PROVINCE_OF = {
    "ababuj": "Teruel",
    "abades": "Segovia",
    "abanilla": "Murcia",
    "abárzuza": "Navarra",
}
UNKNOWN_PROVINCE = "Desconocida"
NORMALISE_FROM = "’áéíóúüñ"
NORMALISE_TO = "'aeiouun"

# --- cells that a CSV reader takes as missing
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- night-light files and names
NIGHT_LIGHT_PREFIX = "viirs_bloque_"
NIGHT_LIGHT_RENAMES = {"LAU_NAME": "municipio"}

# --- weather
WEATHER_ZONE = "Europe/Madrid"
WEATHER_DAYS_BACK = 7
WEATHER_VALUES = {
    "tmax": "double", "tmin": "double",
    "precipitation_sum": "double", "weather_code": "int",
}
