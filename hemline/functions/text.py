"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from hemline.functions.lookups import NAME_TITLES


def standardize(text: Column) -> Column:
    """Trimmed, lower-cased, first letter of every blank-separated word upper."""
    return F.initcap(F.lower(F.trim(text)))


def standardize_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({name: standardize(F.col(name)) for name in names})


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def title_pattern(strict: bool = False) -> str:
    """Case-insensitive pattern for the fixed title list.

    The titles without a final dot have no right word boundary by default, so
    ``Mdina`` loses its first two letters; ``strict`` adds the boundary.
    """
    parts = []
    for title in NAME_TITLES:
        part = title.replace(".", r"\.")
        parts.append(part if title.endswith(".") or not strict else part + r"\b")
    return r"(?i)\b(" + "|".join(parts) + r")\s*"


def strip_titles(name: Column, strict: bool = False) -> Column:
    return F.trim(F.regexp_replace(name, title_pattern(strict), ""))


# Dictionaries travel as one text literal, which the optimizer folds to a constant:
# a plan with hundreds of separate literals takes longer to build than to run.
_ENTRY, _PAIR = "\n", "\t"


def _as_text(names: Mapping[str, str]) -> Column:
    return F.lit(_ENTRY.join(f"{old}{_PAIR}{new}" for old, new in names.items()))


def lookup_or_keep(text: Column, names: Mapping[str, str]) -> Column:
    """Exact-match translation; a value without an entry stays as it is.

    Meant for fixed dictionaries only. A mapping that grows with the data
    belongs in a table, see ``operators.joins.translate_names``.
    """
    known = F.str_to_map(_as_text(names), F.lit(_ENTRY), F.lit(_PAIR))
    return F.coalesce(F.element_at(known, text), text)


def replace_within(text: Column, names: Mapping[str, str]) -> Column:
    """Replace every key found inside the text, one after the other, in order."""
    return F.aggregate(
        F.split(_as_text(names), _ENTRY),
        text,
        lambda done, pair: F.replace(
            done,
            F.split_part(pair, F.lit(_PAIR), F.lit(1)),
            F.split_part(pair, F.lit(_PAIR), F.lit(2)),
        ),
    )


def has_chinese(text: Column) -> Column:
    return text.rlike("[一-鿿]")
