"""Distance expressions (C20)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.constants import KM_PER_DEGREE


def manhattan_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """North-south plus east-west distance; a degree of longitude shrinks with the latitude."""
    north = F.abs(lat2 - lat1) * KM_PER_DEGREE
    east = F.abs(lon2 - lon1) * KM_PER_DEGREE * F.cos(F.radians((lat1 + lat2) / 2))
    return north + east
