"""Declared schemas, so that no reader infers one by a second pass."""

from __future__ import annotations

from pyspark.sql import types as T

from strata.config import RAW_HEADER


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW = _strings(*RAW_HEADER)
RAW_RENAMED = _strings(*RAW_HEADER.values(), "department", "city")

# Keys of the embedded JSON, as the site spells them.
ITEM = _strings(
    "Estado", "Estrato", "Parqueaderos", "Financiación", "Cuota inicial",
    "Pisos interiores", "Aplica subsidio",
)
UNIT = _strings("m² const.", "m² priv.", "Tipo de Inmueble", "Hab/Amb", "Baños", "Precio")
UNIT_TABLE = _strings("area_construida", "area_privada", "tipo_inmueble", "hab_amb", "banos", "precio")
FULL_INFO = _strings(
    "Estrato", "Tipo de Inmueble", "Estado", "Baños", "Área Construida",
    "Área Privada", "Antigüedad", "Habitaciones", "Parqueaderos",
    "Acepta permuta", "Remodelado", "Precio",
)

# Field of one unit under one common name, first spelling then table spelling.
UNIT_FIELDS = {
    "area_construida": ("m² const.", "area_construida"),
    "area_privada": ("m² priv.", "area_privada"),
    "tipo_de_inmueble": ("Tipo de Inmueble", "tipo_inmueble"),
    "habitaciones": ("Hab/Amb", "hab_amb"),
    "banos": ("Baños", "banos"),
    "precio": ("Precio", "precio"),
}
UNITS = T.ArrayType(_strings(*UNIT_FIELDS))

# Fields of map documents and of their counts per cell.
OSM_ELEMENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("nodes", T.ArrayType(T.LongType())),
    T.StructField("tags", _strings("amenity", "shop", "leisure")),
])
OSM = T.StructType([T.StructField("elements", T.ArrayType(OSM_ELEMENT))])

POI_COUNTS = T.StructType(
    [T.StructField("hex_id", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("hospital", "mall", "park", "school")]
)
