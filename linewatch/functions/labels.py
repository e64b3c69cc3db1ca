"""Downtime groups, class names and probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linewatch.schema import DOWNTIME_GROUPS, UNKNOWN


def downtime_group(reason: Column, groups: dict[str, list[str]] | None = None) -> Column:
    """Reason to group; unmapped and null give ``Unknown``."""
    groups = DOWNTIME_GROUPS if groups is None else groups
    pairs = [F.lit(x) for group, reasons in groups.items() for r in reasons for x in (r, group)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), reason), F.lit(UNKNOWN))


def fill_label(c: Column) -> Column:
    """A class as text, null as ``Unknown``."""
    return F.coalesce(c.cast("string"), F.lit(UNKNOWN))


def label_index(c: Column, classes: list[str]) -> Column:
    """Class text to its position among the sorted classes."""
    pairs = [x for i, name in enumerate(classes) for x in (F.lit(name), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), fill_label(c))


def label_name(index: Column, classes: list[str]) -> Column:
    """Position back to class text; positions without a class keep a marker name."""
    index = index.cast("int")
    names = F.array(*[F.lit(name) for name in classes])
    known = F.when(index.between(0, len(classes) - 1), F.get(names, index))
    return F.coalesce(known, F.concat(F.lit("Unknown_Class_"), index.cast("string")))


def class_probabilities(probabilities: Column, classes: list[str], width: int | None = None) -> Column:
    """Probability array to a map of class name to probability."""
    width = len(classes) if width is None else width
    names = [classes[i] if i < len(classes) else f"Class_{i}" for i in range(width)]
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), probabilities)


def best_class(probabilities: Column) -> Column:
    """Position of the largest probability, the first one on ties."""
    return F.array_position(probabilities, F.array_max(probabilities)).cast("int") - 1


def confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def status_icon(group: Column) -> Column:
    """Board colour of a predicted group."""
    return (
        F.when(group == "Normal", "green")
        .when(group == "Infrastructure", "yellow")
        .when(group == "Machine_Issue", "red")
        .otherwise("blue")
    )
