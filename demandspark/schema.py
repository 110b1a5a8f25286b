"""Column names, input schemas and parameters of the demand jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SALES = T.StructType([
    T.StructField("sku", T.StringType()), T.StructField("description", T.StringType()), T.StructField("supplier", T.StringType()),
    T.StructField("license", T.StringType()), T.StructField("platform", T.StringType()), T.StructField("month_name", T.StringType()),
    T.StructField("year", T.IntegerType()), T.StructField("units", T.DoubleType()), T.StructField("sales", T.DoubleType()), T.StructField("cost", T.DoubleType()),
])

# Headings of exported sale sheets, and our names for them.
HEADINGS = {
    "Marca": "supplier", "Plataforma": "platform", "sku": "sku", "Descripción": "description", "Categoría": "license",
    "Mes": "month_name", "Año": "year", "piezas": "units", "Precio venta": "sales", "Costo Alpha": "cost",
}

PRODUCT_KEYS = ["sku", "description", "supplier", "license"]
PANEL_KEYS = [*PRODUCT_KEYS, "platform"]

# Spanish month names in calendar order.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")

# Product labels in the order in which they are tried, and the labels that stand for another one.
LABELS = (
    "organizador", "taza", "termo", "mochila", "lonchera", "lampara", "gorro", "gorra", "almacenamiento", "iman",
    "perchero", "display", "tuper", "repisa", "despertador", "cartera", "guante", "calcetas", "beanie", "infusor",
    "alcancia", "pelotas antiestres", "llavero", "desk mat", "libreta", "botella", "vaso",
    "figuras coleccionables", "juego de mesa", "stickers", "mini mochila", "mochila con ruedas", "lapicera",
    "rompecabezas", "plato", "reloj", "soporte para telefono", "luz", "escritorio", "cabeza", "brick", "bolsa",
    "marco", "bloque", "set magnetico", "brazalete", "black", "estuche", "libr", "funda", "cap", "correa",
    "bolso", "backpack", "soporte", "estante", "pin", "pelota", "case", "minibackpack", "moch", "pulsera",
    "control", "retratos", "portalapices", "light", "clasificadora", "p. rev", "peluche", "vela", "rack",
)
SYNONYMS = {
    "beanie": "guante", "bloque": "brick", "libr": "librero", "backpack": "mochila", "moch": "mochila",
    "retratos": "marco", "estante": "librero", "clasificadora": "organizador", "p. rev": "peluche", "rack": "organizador",
}

# Fixed values: (license, text in the description, new license); the first that holds wins.
LICENSE_RULES = (
    ("DISNEY", "stich", "STITCH"),
    ("DISNEY", "stitch", "STITCH"),
    ("DISNEY", "mandalorian", "THE MANDALORIAN"),
    ("DISNEY", "star wars", "STAR WARS"),
)


@dataclass(frozen=True)
class Params:
    """Parameters of all jobs, with the values of a usual run."""

    platforms: tuple[str, ...] = ("Amazon", "Mercado Libre")
    excluded_suppliers: tuple[str, ...] = ("PROVEEDOR DE PLAYERA",)
    min_sku_units: float = 15
    significance: str = "above"
    price_cell: int = 50
    price_neighbours: int = 2
    price_weights: tuple[float, ...] = (1.0, 0.5, 0.25)
    clusters: int = 200
    drop_at_zero: float = 1.0
    second_point: float = 10.0
    drop_at_second: float = 2.0
    surge: float = 1.25
    drop_stockouts: bool = True
    levels: tuple[str, ...] = ("cluster", "license")
    categories: tuple[str, ...] = ("supplier", "license", "product")
    months_in_year: int = 12
    max_lag: int = 15
    lag_share: float = 0.5
    trend_windows: tuple[int, ...] = (3, 6)
    important_licenses: tuple[str, ...] = ("MINECRAFT", "SUPER MARIO")
    min_titles: int = 2
    title_companies: tuple[str, ...] | None = ("universal_pictures", "warner_bros")
    cutoff: str = "2025-01-01"
    tree_depth: int = 8
    tree_step: float = 0.05
    tree_rounds: int = 40
    reconciliation: str = "wls_struct"
    excluded_features: tuple[str, ...] = ("date", "description", "units", "sales", "year", "sku_platform", "series_id", "cont_sales_id", "level")
    categorical: tuple[str, ...] = ("sku", "sku_platform", "supplier", "license", "platform", "product", "cluster", "level", "series_id", "title_tatus", "title_type", "production_company")
    license_rules: tuple[tuple[str, str, str], ...] = LICENSE_RULES
    labels: tuple[str, ...] = LABELS
    synonyms: dict[str, str] = field(default_factory=lambda: dict(SYNONYMS))
