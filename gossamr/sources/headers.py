"""Raw response headers: Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(raw: Column) -> Column:
    """Array of (name, value): lines with a colon, split at the first one, trimmed, names lower-cased."""
    lines = F.filter(F.split(raw, "\r?\n"), lambda x: F.contains(x, F.lit(":")) & ~F.startswith(x, F.lit("HTTP/")))
    return F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"), F.trim(F.substring(x, F.locate(":", x) + 1, F.length(x)), F.lit(" \t\r")).alias("value")))


def _values(raw: Column, name: str) -> Column:
    return F.transform(F.filter(fields(raw), lambda x: x["name"] == name), lambda x: x["value"])


def last_value(raw: Column, name: str) -> Column:
    return F.try_element_at(_values(raw, name), F.lit(-1))


def annotated_content_type(raw: Column) -> Column:
    """The last content type given, as it stands."""
    return last_value(raw, "content-type")


def served_content_type(raw: Column, override: str | None = None) -> Column:
    """The override if there is one, else the first content type given, else text/plain."""
    return F.lit(override) if override else F.coalesce(F.get(_values(raw, "content-type"), F.lit(0)), F.lit("text/plain"))


def status(line: Column) -> Column:
    """Struct of code and phrase of a status line; without a number for its second word, null and the whole line."""
    words = F.split(F.trim(line, F.lit(" \t\r\n")), r"\s+", 3)
    code = F.get(words, F.lit(1)).try_cast("int")
    return F.struct(code.alias("code"), F.when(code.isNull(), F.trim(line, F.lit(" \t\r\n"))).otherwise(F.coalesce(F.get(words, F.lit(2)), F.lit(""))).alias("phrase"))


def last_status(raw: Column) -> Column:
    """status() of the last status line: after redirects there are several blocks."""
    return status(F.try_element_at(F.filter(F.split(raw, "\r?\n"), lambda x: F.startswith(x, F.lit("HTTP/"))), F.lit(-1)))


def acceptable(content_type: Column, whitelist: tuple[str, ...] = ()) -> Column:
    """Whether the type before ; is text/html or in the whitelist; * accepts all."""
    if "*" in whitelist:
        return F.lit(True)
    return F.lower(F.substring_index(content_type, ";", 1)).isin("text/html", *whitelist)
