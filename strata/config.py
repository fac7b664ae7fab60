"""Settings and fixed values. Everything here is plain data."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: texts the listing sites and raw files really contain. ---
NOT_AVAILABLE = "No disponible"
ASK_MARKERS = ("¡Pregúntale!", "")
POI_CATEGORIES = ("hospital", "mall", "park", "school")
BATCH_ID_FORMAT = "yyyy-MM-dd_HH-mm-ss"

# Raw file header -> column name.
RAW_HEADER = {
    "Fecha": "fecha",
    "URL": "url",
    "Título": "titulo",
    "Constructor": "constructor",
    "Item": "item",
    "Unidades": "unidades",
    "full_info": "full_info",
    "Direccion_Principal": "direccion_principal",
    "Direccion_Asociadas": "direccion_asociadas",
    "lat/lon": "lat_lon",
}

# Columns cleared of surrounding blanks before keys are compared.
TRIMMED = (
    "url", "titulo", "constructor", "direccion_principal",
    "direccion_asociadas", "lat_lon", "department", "city",
)

# Columns of the analytic data set.
GOLD_COLUMNS = (
    "department", "city", "lat", "lon", "hospital", "mall", "park", "school",
    "estrato", "tipo_de_inmueble", "estado", "banos", "habitaciones",
    "area_construida", "area_privada", "parqueaderos", "financiacion",
    "pisos_interiores", "precio",
)
CATEGORICAL = ("department", "city", "tipo_de_inmueble", "estado")
# Bounds of plausible prices and areas, the share of repeats that is too much, and the
# factor of the quartile rule.
PRICE_BOUNDS = (1_000_000, 5_000_000_000)
AREA_BOUNDS = (20, 1_000)
MAX_DUPLICATE_RATIO = 0.5
IQR_FACTOR = 1.5
# --- End of fixed values. ---


@dataclass(frozen=True)
class Settings:
    """Bounds and sizes a run may override."""

    price_bounds: tuple[float, float] = PRICE_BOUNDS
    area_bounds: tuple[float, float] = AREA_BOUNDS
    max_duplicate_ratio: float = MAX_DUPLICATE_RATIO
    iqr_factor: float = IQR_FACTOR
    # Edge of a hexagonal cell in km; the default is the mean edge of an H3
    # cell at resolution 8.
    cell_km: float = 0.461354684
    location_order: str = "city/department"
    # Largest side that may be sent whole to every executor.
    broadcast_bytes: int = 64 * 1024 * 1024
    # Bytes of raw JSON a task parses, and how few it is worth a task of its own for.
    parse_bytes: int = 32 * 1024 * 1024
    least_parse_bytes: int = 256 * 1024
    # Most distinct values one-hot encoding turns into columns of their own; beyond it,
    # ``one_hot_sparse`` has no bound.
    max_categories: int = 1_000
    partition_columns: tuple[str, ...] = field(default=("department", "city"))


DEFAULTS = Settings()
