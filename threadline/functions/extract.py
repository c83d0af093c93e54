"""Dependency extraction from program text.

The patterns describe the regex contract of the data model: Unicode word
characters, Unicode white space, case-insensitive keywords, and a line that
starts only after ``\\n``.  Java's own ``\\w``, ``\\s`` and ``\\b`` differ from
that (marks count as word characters under ``(?U)``, separators such as 0x1c are
not white space), so the character classes are spelled out.

Quantifiers are possessive.  Token and white-space classes are disjoint, so a
possessive match accepts the same texts as a greedy one, without backtracking
and without recursion on statements that list thousands of datasets.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes of the pattern dialect.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# White space that does not end a line.
INLINE_SPACE = r"\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# i: ignore case, m: ^ at line starts, d: only \n ends a line, u: Unicode case.
FLAGS = "(?imdu)"

_LINE_START = f"^[{INLINE_SPACE}]*+"
_NAME_LIST = f"([{WORD}.]++(?:[{SPACE}]++[{WORD}.]++)*+)[{SPACE}]*+;"

READ_STATEMENT = f"{FLAGS}{_LINE_START}(?:set|merge)[{SPACE}]++{_NAME_LIST}"
DATA_STATEMENT = f"{FLAGS}{_LINE_START}data[{SPACE}]++{_NAME_LIST}"
# The keyword stands first: looking back at every character of a text costs more than all else.
OUT_OPTION = f"{FLAGS}out(?<![{WORD}]out)[{SPACE}]*+=[{SPACE}]*+([{WORD}.]++)"
DATA_OPTION = f"{FLAGS}data(?<![{WORD}]data)[{SPACE}]*+=[{SPACE}]*+([{WORD}.]++)"
MACRO_CALL = f"{FLAGS}%([{WORD}]++)[{SPACE}]*+\\("
MACRO_DEFINITION = f"{FLAGS}%macro[{SPACE}]++([{WORD}]++)"
INCLUDE = f"{FLAGS}%include[{SPACE}]++['\"]([^'\"]++)['\"]"
# An include whose path holds a reference.
OPEN_INCLUDE = f"{FLAGS}%include[{SPACE}]++['\"][^'\"&]*+&"
PROC = f"{FLAGS}{_LINE_START}proc[{SPACE}]++([{WORD}]++)"

# Names that look like macro calls but belong to the macro language itself.
# Used only when the caller asks for them to be left out.
MACRO_LANGUAGE_WORDS = (
    "bquote", "do", "else", "eval", "if", "index", "length", "nrbquote",
    "nrstr", "qscan", "qsubstr", "qsysfunc", "qupcase", "quote", "scan", "str",
    "substr", "superq", "symexist", "sysevalf", "sysfunc", "sysget", "then",
    "unquote", "upcase", "until", "while",
)


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """Every match of one group, in text order; an empty array when none."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def sorted_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def split_space(text: Column) -> Column:
    return F.split(text, f"[{SPACE}]+")


def normalize_dataset_name(name: Column) -> Column:
    """Trim, drop trailing ``;`` and ``.``, lower-case; null becomes ``''``."""
    trimmed = F.regexp_replace(name, f"^[{SPACE}]++|[{SPACE}]++\\z", "")
    return F.lower(F.regexp_replace(F.coalesce(trimmed, F.lit("")), r"[;.]++\z", ""))


def _token_name(token: Column) -> Column:
    # A matched token holds word characters and dots only, so the trimming and
    # the semicolon of the general form cannot occur; rtrim stays in codegen.
    return F.lower(F.rtrim(token, F.lit(".")))


def _dataset_set(tokens: Column) -> Column:
    names = F.transform(tokens, _token_name)
    return sorted_set(F.filter(names, lambda n: n != ""))


def _listed(text: Column, pattern: str) -> Column:
    return F.flatten(F.transform(all_matches(text, pattern), split_space))


def _option_names(code: Column, pattern: str, whole_names: bool) -> Column:
    """Names given to an option; ``whole_names`` leaves out those that a reference continues."""
    return all_matches(code, f"{pattern}(?!&)" if whole_names else pattern)


def input_datasets(code: Column, proc_data_as: str = "output", whole_names: bool = False) -> Column:
    """Datasets read by SET or MERGE (plus ``DATA=`` when it counts as input).

    SET and MERGE share one pass: when either keyword opens a line inside the
    other's name list, the shorter list is a tail of the longer one.
    """
    tokens = _listed(code, READ_STATEMENT)
    if _data_option_side(proc_data_as) == "input":
        tokens = F.concat(tokens, _option_names(code, DATA_OPTION, whole_names))
    return _dataset_set(tokens)


def output_datasets(code: Column, proc_data_as: str = "output", whole_names: bool = False) -> Column:
    """DATA targets, every ``OUT=`` and, by default, every ``DATA=``."""
    tokens = F.concat(_listed(code, DATA_STATEMENT), _option_names(code, OUT_OPTION, whole_names))
    if _data_option_side(proc_data_as) == "output":
        tokens = F.concat(tokens, _option_names(code, DATA_OPTION, whole_names))
    return _dataset_set(tokens)


def _data_option_side(proc_data_as: str) -> str:
    if proc_data_as not in ("output", "input"):
        raise ValueError(f"proc_data_as must be 'output' or 'input', not {proc_data_as!r}")
    return proc_data_as


def macro_calls(code: Column, skip_language_words: bool = False) -> Column:
    """Names followed by ``(`` after ``%``, lower-cased."""
    names = F.transform(all_matches(code, MACRO_CALL), F.lower)
    if skip_language_words:
        names = F.filter(names, lambda n: ~n.isin(*MACRO_LANGUAGE_WORDS))
    return sorted_set(names)


def include_files(code: Column) -> Column:
    """Quoted ``%include`` paths, case kept."""
    return sorted_set(all_matches(code, INCLUDE))


def proc_types(code: Column) -> Column:
    """PROC names at line starts, lower-cased."""
    return sorted_set(F.transform(all_matches(code, PROC), F.lower))


def has_dynamic_deps(code: Column) -> Column:
    """True when the text holds an ampersand anywhere."""
    return F.contains(code, F.lit("&"))


def line_array(code: Column) -> Column:
    """Lines as a line reader returns them: no terminators, no empty tail."""
    lines = F.split(code, "\r\n|\n|\r")
    return F.when(
        F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)
    ).otherwise(lines)
