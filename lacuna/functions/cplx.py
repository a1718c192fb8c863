"""Complex numbers as two double columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def magnitude(re: Column, im: Column) -> Column:
    return F.sqrt(re * re + im * im)


def phase(re: Column, im: Column) -> Column:
    return F.atan2(im, re)


def multiply(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def conjugate(a: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0], -a[1]


def unit(angle: Column) -> tuple[Column, Column]:
    return F.cos(angle), F.sin(angle)
