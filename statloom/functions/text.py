"""Labels, names, footnotes and messages."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.fixed_values import LABEL_SEPARATOR


def label_key(*labels: Column) -> Column:
    """Labels joined to one column key; a missing label is written ``NA``."""
    return F.array_join(F.array(*labels), LABEL_SEPARATOR, "NA")


def label_part(key: Column, level: int) -> Column:
    """Label of one level (from 1) of a column key; NULL beyond the last."""
    return F.get(F.split(key, LABEL_SEPARATOR), F.lit(level - 1))


def dataset_slug(*reference: Column) -> Column:
    """File name of a dataset reference (category, group, dataset)."""
    return F.replace(F.concat_ws(LABEL_SEPARATOR, *reference), F.lit("/"), F.lit(" "))


def strip_suffix(label: Column, suffix: str) -> Column:
    return F.replace(label, F.lit(suffix), F.lit(""))


def decode_entities(text: Column) -> Column:
    """The entities that hand-written fragments use; ``&amp;`` last, so that nothing is decoded twice."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", "\xa0"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def strip_space(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def footnote_text(html: Column) -> Column:
    """Readable footnote: tags to line breaks, runs of them to one, one at the end."""
    text = decode_entities(F.regexp_replace(html, "<[^>]*>", "\n"))
    text = F.regexp_replace(strip_space(text), "\n+", "\n")
    return F.when(F.endswith(text, F.lit("\n")), text).otherwise(F.concat(text, F.lit("\n")))


def fragment_text(html: Column) -> Column:
    return strip_space(decode_entities(F.regexp_replace(html, "<[^>]*>", "")))


def first_href(html: Column) -> Column:
    """Target of the first link, NULL without one."""
    href = F.regexp_extract(html, r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']""", 1)
    return decode_entities(F.nullif(href, F.lit("")))


def captured_number(text: Column, pattern: str) -> Column:
    """First group of a pattern that has to match from the start; NULL without a match."""
    return F.nullif(F.regexp_extract(text, f"^(?:{pattern})", 1), F.lit(""))


def message(template: str, **fields: Column) -> Column:
    """A template with ``{name}`` places, filled from columns."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(F.coalesce(fields[name].cast("string"), F.lit("None")))
    return F.concat(*parts)
