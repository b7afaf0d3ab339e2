"""What a photo's file name says about its vehicle, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words for car or vehicle that a number may follow (lower case, with and without accent).
VEHICLE_WORDS = ("car", "cars", "coche", "coches", "carro", "auto", "automovil", "automóvil", "veh", "vehiculo", "vehículo", "vehicle", "veiculo", "veículo", "viatura")
#: Words that may stand between the vehicle's number and the number of the shot.
SHOT_WORDS = ("foto", "photo", "fotografia", "img", "image", "imagen", "imagem", "pic", "shot", "toma", "vista", "view")

_VEHICLE = r"(?iu)(?:^|[^\p{L}])(?:" + "|".join(sorted(VEHICLE_WORDS, key=len, reverse=True)) + r")[^\p{L}\p{N}]*(\d+)"
_SHOT = _VEHICLE + r"[^\p{L}\p{N}]+(?:(?:" + "|".join(SHOT_WORDS) + r")[^\p{L}\p{N}]*)?(\d+)"


def base_name(path: Column) -> Column:
    """Last element of a path, for either slash."""
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def _plain(number: Column) -> Column:
    """Digits without leading zeros; null where there are none."""
    return F.when(number != "", F.regexp_replace(number, r"^0+(?=\d)", ""))


def vehicle_number(path: Column) -> Column:
    """Number that follows a word for car or vehicle, without leading zeros, or null."""
    return _plain(F.regexp_extract(base_name(path), _VEHICLE, 1))


def shot_number(path: Column) -> Column:
    """Number of the shot after the vehicle's number, without leading zeros, or null."""
    return _plain(F.regexp_extract(base_name(path), _SHOT, 2))
