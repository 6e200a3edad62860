"""Names and ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_name(name: Column) -> Column:
    """Lower case, letters and digits only: 'PM2.5' -> 'pm25'."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def alias_product(product: Column) -> Column:
    """Upper case, with the short form of the aerosol index spelled out."""
    name = F.upper(F.trim(product))
    return F.when(name == "AER", "AER_AI").otherwise(name)


def safe_id(raw: Column) -> Column:
    """An id fit for a file name: other characters than letters, digits, dot, dash and underscore become one underscore."""
    return F.regexp_replace(raw, "[^A-Za-z0-9_.-]+", "_")


def run_id(direction: Column, init: Column, lat: Column, lon: Column, alt: Column) -> Column:
    return safe_id(F.format_string("%s_%s_lat%.3f_lon%.3f_alt%d", direction, F.date_format(init, "yyyyMMddHH"), lat, lon, F.round(alt).cast("long")))


def label_of(code: Column, labels: Mapping[int, str], other: str = "unknown") -> Column:
    """The label of a code; codes without one, and null, get `other`."""
    pairs = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, code), F.lit(other))


def first_link(links: Column) -> Column:
    """href of the first of an array of links (href, inherited, ..) that is not inherited, or null."""
    own = F.filter(links, lambda x: x["href"].isNotNull() & ~F.coalesce(x["inherited"], F.lit(False)))
    return F.get(own, F.lit(0))["href"]
