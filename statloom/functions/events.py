"""Fields written into the body text of a calendar event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.functions.text import first_href, fragment_text, strip_space

# `d`: a line ends at \n only. `i`: any case.


def body_files(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(r"(?id)files:(.*)\n"), F.lit(1)), strip_space)


def body_url(body: Column) -> Column:
    return first_href(F.regexp_extract(body, r"(?id)url:(.*)\n", 1))


def body_script(body: Column) -> Column:
    """NULL without a script line."""
    found = F.regexp_extract(body, r"(?id)script:(.*)", 0) != ""
    return F.when(found, fragment_text(F.regexp_extract(body, r"(?id)script:(.*)", 1)))
