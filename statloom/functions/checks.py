"""The page check: does an element's text carry the expected date?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.fixed_values import (
    DATE_PLACEHOLDER,
    NOT_FOUND_ERROR,
    SELECTOR_ERROR,
    TEMPLATE_ERROR,
    TEMPLATE_MISMATCH_ERROR,
)


def literal_pattern(text: Column) -> Column:
    """A pattern that matches the text itself."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def template_check(
    template: Column,
    date_text: Column,
    selector_kind: Column,
    selector: Column,
    found: Column,
    element_text: Column,
    raw_regex: bool = False,
    problem: Column | None = None,
) -> Column:
    """``struct<updated boolean, info string>``; ``updated`` is NULL when the check could not be made.

    The tests run in a fixed order: template, selector, element, template on the text, date on the
    text. An empty selector counts as absent. The date is matched as a literal unless ``raw_regex``.
    ``problem``, if not NULL, says why the selector could not be tried.
    """
    problem = F.lit(None).cast("string") if problem is None else problem
    places = (F.length(template) - F.length(F.replace(template, F.lit(DATE_PLACEHOLDER), F.lit("")))) / len(
        DATE_PLACEHOLDER
    )
    any_date = F.replace(template, F.lit(DATE_PLACEHOLDER), F.lit(".*"))
    this_date = F.replace(
        template, F.lit(DATE_PLACEHOLDER), date_text if raw_regex else literal_pattern(date_text)
    )
    one_selector = F.coalesce(selector_kind.isin("xpath", "css") & (F.length(selector) > 0), F.lit(False))

    def failed(info):
        return F.struct(F.lit(None).cast("boolean").alias("updated"), info.alias("info"))

    def done(updated):
        return F.struct(F.lit(updated).alias("updated"), element_text.alias("info"))

    return (
        F.when(F.coalesce(places != 1, F.lit(True)), failed(F.lit(TEMPLATE_ERROR)))
        .when(~one_selector, failed(F.lit(SELECTOR_ERROR)))
        .when(problem.isNotNull(), failed(problem))
        .when(~F.coalesce(found, F.lit(False)), failed(F.concat(F.lit(NOT_FOUND_ERROR), selector_kind)))
        .when(~F.rlike(element_text, any_date), failed(F.lit(TEMPLATE_MISMATCH_ERROR)))
        .when(F.rlike(element_text, this_date), done(True))
        .otherwise(done(False))
    )
