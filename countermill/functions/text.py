"""Column functions on names, paths, configuration and markup text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column
from countermill.functions.counters import last_entries


def last_value(dn: ColumnLike) -> Column:
    """Text after the last ``=`` of a distinguished name: its last value."""
    return F.substring_index(as_column(dn), "=", -1)


def rdn_class(moid: ColumnLike) -> Column:
    """Object class: in the last comma part, the text before the first ``=``."""
    return F.substring_index(F.substring_index(as_column(moid), ",", -1), "=", 1)


def column_name(name: ColumnLike) -> Column:
    """Counter name as a table column: ``-`` and ``.`` become ``_``, lower case."""
    return F.lower(F.translate(as_column(name), "-.", "__"))


def table_name(name: ColumnLike) -> Column:
    """Entity name as a table name: ``-`` and ``.`` become ``_``."""
    return F.translate(as_column(name), "-.", "__")


def split_suffix_removed(name: ColumnLike) -> Column:
    """Entity name without the ``_<n>`` of a column split."""
    return F.regexp_replace(as_column(name), r"_\d+$", "")


def is_split(name: ColumnLike) -> Column:
    """True for the name of a column split: it ends in digits."""
    return as_column(name).rlike(r"\d+$")


def store_path(pack: ColumnLike, release: ColumnLike, entity: ColumnLike) -> Column:
    """Cold-store folder of an entity: ``/<pack parts>/<release>/<entity>``."""
    return F.concat(
        F.lit("/"),
        F.replace(as_column(pack), F.lit("_"), F.lit("/")),
        F.lit("/"),
        as_column(release),
        F.lit("/"),
        as_column(entity),
    )


def config_map(text: ColumnLike) -> Column:
    """``k=v::k=v`` as a map. A value ends at its next ``=``."""
    pairs = F.filter(F.split(as_column(text), "::"), lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.split_part(p, F.lit("="), F.lit(2)).alias("value"),
        ),
    )
    return F.map_from_entries(last_entries(entries))


def config_text(values: ColumnLike) -> Column:
    """A map as ``k=v::k=v`` text, keys in order."""
    entries = F.array_sort(F.map_entries(as_column(values)))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), "::")


def delimited_field(text: ColumnLike, position: int) -> Column:
    """Field ``position`` (from 0) of ``:``-separated text, up to its comma, trimmed."""
    part = F.try_element_at(F.split(as_column(text), ":"), F.lit(position + 1))
    return F.trim(F.substring_index(part, ",", 1))


def last_field(text: ColumnLike) -> Column:
    """Text after the last ``:``, trimmed."""
    return F.trim(F.substring_index(as_column(text), ":", -1))


def version_text(name: ColumnLike, version: ColumnLike, release: ColumnLike) -> Column:
    """Model version: last ``_`` part of the model name, version and release, dotted."""
    return F.concat_ws(".", F.substring_index(as_column(name), "_", -1), as_column(version), as_column(release))


def last_word(text: ColumnLike) -> Column:
    """Text after the last blank."""
    return F.substring_index(as_column(text), " ", -1)


# Characters cleaned before markup is written, and XML entities.
SPECIAL_CHARACTERS = [("\x96", " "), ("\xa0", " "), ("›", ""), ("\x85", "...")]
XML_ENTITIES = [("&", "&amp;"), ('"', "&quot;"), (">", "&gt;"), ("<", "&lt;")]


def _replace_each(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def clean_special(text: ColumnLike) -> Column:
    """Replace special characters that markup must not carry."""
    return _replace_each(as_column(text), SPECIAL_CHARACTERS)


def escape_xml(text: ColumnLike) -> Column:
    """Text safe to place in markup."""
    return _replace_each(clean_special(text), XML_ENTITIES)


def unescape_xml(text: ColumnLike) -> Column:
    """Markup entities back to text; NULL becomes empty. ``&amp;`` goes last."""
    back = [("&lt;", "<"), ("&gt;", ">"), ("&apos;", "'"), ("&quot;", '"'), ("&amp;", "&")]
    return _replace_each(F.coalesce(as_column(text), F.lit("")), back)
