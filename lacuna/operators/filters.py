"""Record filters and extractions on contact data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.values import (
    any_element,
    as_array,
    has_visible_text,
    literal,
    path,
    text_or_null,
)
from lacuna.sources.ndjson import mentioning, parse_fields

# The mobile phone or one of the phone numbers is a string that is not blank.
HAS_PHONE = (
    f"({has_visible_text(text_or_null('record.mobile_phone'))} OR "
    + any_element("record.phone_numbers", has_visible_text(text_or_null("x")))
    + ")"
)


def lines_with_phone(lines: DataFrame) -> DataFrame:
    """The lines, unchanged, of records with a usable phone."""
    maybe = mentioning(lines, '"mobile_phone"', '"phone_numbers"')
    return _lines_where(maybe, ["mobile_phone", "phone_numbers"], HAS_PHONE, "replacing")


def lines_with_email_domain(lines: DataFrame, suffix: str = "@google.com") -> DataFrame:
    """The lines, unchanged, where some ``emails[].address`` ends in the suffix."""
    address = text_or_null(path("x", "address"))
    test = any_element("record.emails", f"endswith({address}, {literal(suffix)})")
    return _lines_where(mentioning(lines, suffix), ["emails"], test, "strict")


def lines_with_skill(lines: DataFrame, *skills: str) -> DataFrame:
    """The lines, unchanged, where some element of ``skills`` is one of these."""
    wanted = ", ".join(literal(skill) for skill in skills)
    test = any_element("record.skills", f"{text_or_null('x')} IN ({wanted})")
    maybe = mentioning(lines, *[f'"{skill}"' for skill in skills])
    return _lines_where(maybe, ["skills"], test, "strict")


def extract_emails(lines: DataFrame, bare_strings: bool = False) -> DataFrame:
    """One row per address in ``emails``: the other columns and ``address``.

    ``bare_strings`` also takes elements that are the address itself.
    """
    others = [c for c in lines.columns if c != "value"]
    address = text_or_null(path("x", "address"))
    if bare_strings:
        address = f"coalesce({address}, {text_or_null('x')})"
    return (
        parse_fields(mentioning(lines, '"emails"'), ["emails"])
        .selectExpr(*others, f"explode({as_array('record.emails')}) AS x")
        .selectExpr(*others, f"{address} AS address")
        .where("address IS NOT NULL")
    )


def phone_match_rate(lines: DataFrame) -> DataFrame:
    """Lines matched by the phone filter, and all non-empty lines, JSON or not."""
    counted = lines.selectExpr("value <> '' AS counted", "value")
    records = parse_fields(
        counted, ["mobile_phone", "phone_numbers"], keep="all", reader="replacing"
    )
    return records.agg(
        F.count_if(F.expr(HAS_PHONE)).alias("matched"), F.count_if("counted").alias("total")
    )


def _lines_where(lines: DataFrame, fields: list[str], test: str, reader: str) -> DataFrame:
    columns = lines.columns
    records = parse_fields(lines.withColumn("_line", F.col("value")), fields, reader=reader)
    return records.where(test).withColumnRenamed("_line", "value").select(*columns)
