"""SQL expressions over JSON values held in VARIANT.

Each function takes and returns the text of a SQL expression, so expressions nest
(also inside lambdas) and a projection of 78 columns reaches the session in one
call.  ``path`` names a member, the others look at a value.

The three getters differ on purpose in what they do with null, missing and
mistyped members, and ``is_void`` differs from what the cleaner removes.
"""

from __future__ import annotations

# The white space that a JavaScript trim() removes, as a regex class.
JS_WHITESPACE = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"


def literal(text: str) -> str:
    """A string literal with this text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted column or field name."""
    return "`" + column.replace("`", "``") + "`"


def path(value: str, *keys: str) -> str:
    """The member found by following these keys, each taken literally."""
    steps = "".join(f"['{key}']" if "'" not in key else f'["{key}"]' for key in keys)
    return f"variant_get({value}, {literal('$' + steps)}, 'variant')"


def as_object(value: str) -> str:
    """Members as MAP<STRING, VARIANT>; NULL unless the value is an object."""
    return f"try_cast({value} AS map<string, variant>)"


def as_array(value: str) -> str:
    """Elements as ARRAY<VARIANT>; NULL unless the value is an array."""
    return f"try_cast({value} AS array<variant>)"


def text_or_null(value: str) -> str:
    """The string, only if the value is a JSON string: ``7`` gives NULL, not '7'."""
    # Most members are null, which costs less to see than a type to spell.
    return f"CASE WHEN NOT is_variant_null({value}) AND schema_of_variant({value}) = 'STRING' THEN cast({value} AS string) END"


def int32_or_null(value: str) -> str:
    """An integer in the signed 64-bit range, wrapped to 32 bits; else NULL."""
    wrapped = f"pmod(cast({value} AS decimal(20,0)) + {2**31}, {2**32}) - {2**31}"
    return f"CASE WHEN schema_of_variant({value}) = 'BIGINT' THEN cast({wrapped} AS int) END"


def json_text(value: str) -> str:
    """Compact JSON text of any value: null gives 'null', missing gives NULL."""
    return f"to_json({value})"


# Year, month and day with one separator throughout; a time of day and a zone may follow.
_DATE = (
    r"^\s*([0-9]{1,6}([-/\\ ])[0-9]{1,2}\2[0-9]{1,2})"
    r"(?:[ T](?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:\.[0-9]+)?)?"
    r"(?: ?(?:Z|UTC|[+-][0-9]{2}(?::?[0-9]{2})?))?)?\s*$"
)


def lenient_date(text: str) -> str:
    """Text to DATE, spaces around and a time of day after it ignored; anything but a
    calendar date gives NULL."""
    day = f"regexp_extract({text}, r'{_DATE}', 1)"
    return rf"try_to_date(regexp_replace({day}, r'[/\\ ]', '-'), 'y-M-d')"


def strict_date(text: str) -> str:
    """Text to DATE; anything but a calendar date raises and ends the job."""
    return (
        f"CASE WHEN ({text}) IS NULL THEN NULL ELSE coalesce({lenient_date(text)}, "
        f"cast(raise_error(concat('not a date: ', {text})) AS date)) END"
    )


def is_empty_container(value: str) -> str:
    """[] or {}, without serialising or descending into the value."""
    # size(NULL) is NULL or -1, depending on the session.
    sizes = [f"coalesce(size({kind}), -1) = 0" for kind in (as_array(value), as_object(value))]
    return f"({sizes[0]} OR {sizes[1]})"


def is_void(value: str) -> str:
    """null, [] or {}: the profile's notion of a field without content ("" has some)."""
    return f"(is_variant_null({value}) OR {is_empty_container(value)})"


def is_scalar(value: str) -> str:
    """A string, number or boolean."""
    return (
        f"(NOT is_variant_null({value}) AND {as_array(value)} IS NULL "
        f"AND {as_object(value)} IS NULL)"
    )


def has_visible_text(text: str) -> str:
    """Something is left after trimming the JavaScript white space; false for NULL."""
    return f"coalesce(rlike({text}, r'[^{JS_WHITESPACE}]'), false)"


def any_element(value: str, test: str) -> str:
    """True if the value is an array and the test holds for an element ``x`` of it."""
    return f"coalesce(exists({as_array(value)}, x -> coalesce({test}, false)), false)"
