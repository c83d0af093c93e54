"""Path expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*+:(//[^/]*+)?"


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    """Text up to and including the last slash; empty when there is none."""
    return F.regexp_replace(path, r"[^/]*+\z", "")


def plain_path(path: Column) -> Column:
    """The path without scheme and authority: ``file:///a/b`` is ``/a/b``."""
    return F.regexp_replace(path, _SCHEME, "")


def collapse_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; leading ``..`` stay."""
    empty = F.array().cast("array<string>")

    def step(acc: Column, segment: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        can_pop = (segment == "..") & (F.size(acc) > 0) & ~F.coalesce(last, F.lit("")).isin("..", "")
        return (
            F.when(segment == ".", acc)
            .when(can_pop, F.slice(acc, F.lit(1), F.size(acc) - 1))
            .otherwise(F.concat(acc, F.array(segment)))
        )

    folded = F.array_join(F.aggregate(F.split(path, "/"), empty, step), "/")
    return F.when(F.rlike(path, F.lit(r"(^|/)\.\.?(/|$)")), folded).otherwise(path)


def candidate_path(including_file: Column, include_text: Column) -> Column:
    """The path an include text stands for, seen from the including file."""
    path = forward_slashes(include_text)
    rooted = F.rlike(path, F.lit(r"^(/|[A-Za-z][A-Za-z0-9+.-]*:)"))
    return collapse_dots(F.when(rooted, path).otherwise(F.concat(folder(including_file), path)))
