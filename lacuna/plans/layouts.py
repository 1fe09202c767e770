"""Column layouts of the typed tables and the projections that fill them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lacuna.functions.values import (
    int32_or_null,
    json_text,
    lenient_date,
    name,
    strict_date,
    text_or_null,
)
from lacuna.sources.ndjson import parse_fields

# The 78 columns of the wide table, in order.  ":i" marks 32-bit
# integers, ":j" nested data kept as JSON text; the rest are strings.
WIDE = """
id full_name first_name middle_initial middle_name last_name gender birth_year:i birth_date
linkedin_url linkedin_username linkedin_id facebook_url facebook_username facebook_id
twitter_url twitter_username github_url github_username work_email mobile_phone industry
job_title job_title_role job_title_sub_role job_title_levels:j
job_company_id job_company_name job_company_website job_company_size job_company_founded:i
job_company_industry job_company_linkedin_url job_company_linkedin_id job_company_facebook_url
job_company_twitter_url job_company_location_name job_company_location_locality
job_company_location_metro job_company_location_region job_company_location_geo
job_company_location_street_address job_company_location_address_line_2
job_company_location_postal_code job_company_location_country job_company_location_continent
job_last_updated job_start_date job_summary
location_name location_locality location_metro location_region location_country
location_continent location_street_address location_address_line_2 location_postal_code
location_geo location_last_updated linkedin_connections:i inferred_salary
inferred_years_experience:i summary phone_numbers:j emails:j interests:j skills:j
location_names:j regions:j countries:j street_addresses:j experience:j education:j profiles:j
certifications:j languages:j version_status:j
""".split()

# The 12 columns of the narrow table; ":d" marks the date.
NARROW = """
id full_name gender job_title location_country location_region location_continent
job_last_updated:d experience:j education:j profiles:j version_status:j
""".split()

NARROW_STRINGS = [column.removesuffix(":d") for column in NARROW]

LAYOUTS = {"wide": WIDE, "narrow": NARROW, "narrow_strings": NARROW_STRINGS}

_GETTERS = {
    "": text_or_null,
    "i": int32_or_null,
    "j": json_text,
    "d": lambda value: strict_date(text_or_null(value)),
    "D": lambda value: lenient_date(text_or_null(value)),
}


def project(
    lines: DataFrame,
    layout: str | Sequence[str] = "wide",
    keep: Sequence[str] = (),
    strict_dates: bool = True,
) -> DataFrame:
    """JSON objects to the columns of a layout, after the ``keep`` columns.

    A date that is not one ends the job, or with ``strict_dates=False`` is NULL.
    A custom layout is a list of ``name`` or ``name:kind`` (kinds i, j, d).
    """
    specs = [c.partition(":") for c in (LAYOUTS[layout] if isinstance(layout, str) else layout)]
    columns = []
    for field, _, kind in specs:
        getter = _GETTERS["D" if kind == "d" and not strict_dates else kind]
        columns.append(f"{getter('record.' + name(field))} AS {name(field)}")
    records = parse_fields(lines.select(*keep, "value"), [field for field, *_ in specs])
    return records.selectExpr(*map(name, keep), *columns)
