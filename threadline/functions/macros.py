"""Macro variables and macros that a program defines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadline.functions.extract import FLAGS, MACRO_DEFINITION, SPACE, WORD, all_matches, sorted_set

LET_STATEMENT = f"{FLAGS}%let[{SPACE}]++([{WORD}]++[{SPACE}]*+=[^;]*+);"


def let_definitions(code: Column) -> Column:
    """``%let`` definitions in text order, as (name, value) structs.

    Names are lower-cased because macro names ignore case. A name defined more
    than once appears more than once.
    """
    parts = all_matches(code, LET_STATEMENT)
    return F.transform(
        parts,
        lambda p: F.struct(
            F.lower(F.regexp_replace(F.substring_index(p, "=", 1), f"[{SPACE}]++", "")).alias("name"),
            F.regexp_replace(
                F.substr(p, F.instr(p, "=") + 1), f"^[{SPACE}]++|[{SPACE}]++\\z", ""
            ).alias("value"),
        ),
    )


def last_definitions(definitions: Column) -> Column:
    """One struct per name, the last one in text order, by name.

    Definitions are sorted by name and place, so the last of a name is the one
    before another name.
    """
    placed = F.array_sort(F.transform(definitions, lambda d, i: F.struct(d["name"].alias("name"), i.alias("i"), d["value"].alias("value"))))
    # The sorted array is bound once, as the only element of another.
    last = lambda s: F.filter(s, lambda d, i: (i + 1 == F.size(s)) | (F.get(s, i + 1)["name"] != d["name"]))
    kept = F.element_at(F.transform(F.array(placed), last), 1)
    return F.transform(kept, lambda d: F.struct(d["name"].alias("name"), d["value"].alias("value")))


def definition_map(definitions: Column) -> Column:
    return F.map_from_entries(last_definitions(definitions))


def macro_names(code: Column) -> Column:
    """Names defined by ``%macro``, lower-cased."""
    return sorted_set(F.transform(all_matches(code, MACRO_DEFINITION), F.lower))
