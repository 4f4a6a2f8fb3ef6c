"""Instructions, names, paths and answers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: What stands before the material in an instruction.
MATERIALS = ["Change the object's material to ", "Repaint the object in ", "Repaint the object with "]


def without(text: Column, pieces: list[str]) -> Column:
    """The text without any of the pieces."""
    for piece in pieces:
        text = F.replace(text, F.lit(piece), F.lit(""))
    return text


def filled(template: Column, values: dict[str, Column]) -> Column:
    """The template with each slot replaced by its value."""
    for slot, value in values.items():
        template = F.replace(template, F.lit(slot), value)
    return template


def addable(name: Column, allowed: list[str], blocked: list[str]) -> Column:
    """Whether a part of this name can be added: not if the whole name is blocked; else if it, or any word of it, is allowed."""
    whole = F.lower(F.trim(name))
    words = F.split(whole, r"\s+")
    return ~whole.isin(blocked) & (whole.isin(allowed) | F.arrays_overlap(words, F.array(*map(F.lit, allowed))))


def braced(answer: Column) -> Column:
    """From the first brace to the last, line ends included; null if there are none."""
    return F.nullif(F.regexp_extract(answer, r"(?s)\{.*\}", 0), F.lit(""))


def named(answer: Column, default: str = "part") -> Column:
    """The name that a model's answer gives as {"part": name}, lower-cased; the default where it gives none."""
    return F.coalesce(F.lower(F.trim(F.from_json(braced(answer), "part string").part)), F.lit(default))


def before(text: Column, marker: str) -> Column:
    return F.substring_index(text, marker, 1)
