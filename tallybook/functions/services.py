"""Which services count as maps services, and which service names the cost views leave out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service names billed as maps services.
MAPS_SERVICE_NAMES = [
    "Distance Matrix API",
    "Street View API",
    "Zagat content in the Places API",
    "Maps Static API",
    "Places API for iOS",
    "Maps Elevation API",
    "Maps API",
    "Places API for Android",
    "Street View Static API",
    "Geocoding API",
    "Maps Reseller Program",
    "Google Maps Android API",
    "Maps and Street View API",
    "Directions API",
    "Maps JavaScript API",
    "Google Maps SDK for iOS",
    "Places API",
    "Time Zone API",
    "Maps Embed API",
    "Roads API",
    "Geolocation API",
    "Navigation API",
    "Google Maps Platform Rides and Deliveries Service",
]

# LIKE patterns (case-sensitive) that also mark a maps service.
MAPS_NAME_PATTERNS = ["%maps%", "%Maps%", "%Place%"]

# Services left out of the account-level cloud costs, and of the maps costs.
CLOUD_EXCLUDED = ["Invoice", "Maps Reseller Program", "Reseller Program", "SendGrid"]
MAPS_EXCLUDED = ["Anthos", "Invoice", "Maps Reseller Program", "Reseller Program", "Support", "SendGrid"]

# Service lines that carry the old-style reseller discount.
PROGRAM_SERVICES = ["Reseller Program", "Maps Reseller Program"]

# Fixed value: the SKU that carries the enhanced-support fee.
SUPPORT_SKU = "GCP Partner-led Enhanced Support Variable Fee"


def is_maps_service(service: Column, listed: Column) -> Column:
    """True for a maps service; ``listed`` says whether the maps lookup names it. NULL names stay NULL."""
    test = service.isin(MAPS_SERVICE_NAMES)
    for pattern in MAPS_NAME_PATTERNS:
        test = test | service.like(pattern)
    return test | listed


def is_support_fee(sku: Column) -> Column:
    return sku == F.lit(SUPPORT_SKU)
