"""Safe casts over parsed API values (Variant columns).

Records from JSON bodies keep their value types (number, string, boolean,
null) in a VARIANT; XML values are always strings.  The rules below follow
the loader's Python helpers, written as Spark column expressions:

* ``safe_int``: NULL, '' or blank -> NULL; text must be an optionally signed
  integer after trimming; a number is truncated toward zero; junk -> NULL.
* ``safe_double``: NULL/blank -> NULL; otherwise the value as a double.
* ``safe_date``: the first 10 characters as ``Y-M-D`` (1-2 digit month/day),
  else NULL (a bare year is not a date).
* ``safe_bool``: true for true/'1'/'true'/'yes'/'on' (trimmed, any case),
  false otherwise, including NULL.
* ``truthy``: Python truthiness: NULL, '', 0 and false are falsy, '0' is not.
* ``text``: the value as text if truthy, else NULL (``x or None``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed literal sets of the loader.
TRUE_WORDS = ("1", "true", "yes", "on")
_INT_TEXT = r"^[+-]?[0-9]+$"
_DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_BLANK = " \t\n\r\x0b\x0c"

# Kinds of a VARIANT value, as numbers, so that rules compare numbers and not type names.
VOID, STRING, WHOLE, FRACTION, BOOLEAN, OTHER = range(6)


def kind_name(v: Column) -> Column:
    """The value's type name: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, OBJECT..., VOID."""
    return F.schema_of_variant(v)


def kind_of(name: Column) -> Column:
    """The kind of a type name.  VARIANT stores an integer that fits a long as BIGINT, so a DECIMAL
    of up to 18 digits came from text with a fraction or exponent (1.0 is DECIMAL(1,0))."""
    return (F.when(name == "STRING", STRING).when(name == "BIGINT", WHOLE).when(name == "VOID", VOID)
            .when(name.startswith("DECIMAL"), F.when(name.rlike(r"^DECIMAL\((19|[2-3][0-9]),\s*0\)$"), WHOLE).otherwise(FRACTION))
            .when(name.isin("INT", "SMALLINT", "TINYINT"), WHOLE).when(name.isin("DOUBLE", "FLOAT"), FRACTION)
            .when(name == "BOOLEAN", BOOLEAN).when(name.isNotNull(), OTHER))


def kind(v: Column) -> Column:
    return kind_of(kind_name(v))


class Val:
    """A VARIANT value with its kind, so the kind is derived once per field.

    Every helper below takes a Column or a Val; normalisers pass Vals whose
    kind was computed in an earlier projection.
    """

    def __init__(self, v: Column, k: Column | None = None, s: Column | None = None,
                 t: Column | None = None):
        self.v = v
        self.k = kind(v) if k is None else k
        self.s = F.try_variant_get(v, "$", "string") if s is None else s
        self.t = t          # precomputed truthiness, if any


def _val(x: Column | Val) -> Val:
    return x if isinstance(x, Val) else Val(x)


def is_missing(x: Column | Val) -> Column:
    """Absent key or JSON null."""
    x = _val(x)
    return x.v.isNull() | (x.k == VOID)


def _is_number(x: Val) -> Column:
    return (x.k == WHOLE) | (x.k == FRACTION)


def _is_string(x: Val) -> Column:
    return x.k == STRING


def as_string(x: Column | Val) -> Column:
    """The value as text; NULL for null/absent.

    A fractional JSON number is a float to the loader, so 1.0 reads "1.0"
    (not "1"); integers keep their digits.
    """
    x = _val(x)
    return F.when(x.k == FRACTION, F.try_variant_get(x.v, "$", "double").cast("string")) \
        .otherwise(x.s)


def _strip(s: Column) -> Column:
    return F.trim(s, F.lit(_BLANK))


def safe_int(x: Column | Val) -> Column:
    x = _val(x)
    s = _strip(x.s)
    from_text = F.when(s.rlike(_INT_TEXT), s.try_cast("long"))
    from_number = F.try_variant_get(x.v, "$", "double").try_cast("long")
    from_bool = F.when(x.k == BOOLEAN, F.try_variant_get(x.v, "$", "boolean").cast("long"))
    return (F.when(_is_string(x), from_text)
            .when(_is_number(x), from_number)
            .otherwise(from_bool))


def safe_double(x: Column | Val) -> Column:
    x = _val(x)
    s = _strip(x.s)
    return (F.when(_is_string(x), F.when(s != "", s.try_cast("double")))
            .when(_is_number(x), F.try_variant_get(x.v, "$", "double"))
            .when(x.k == BOOLEAN, F.try_variant_get(x.v, "$", "boolean").cast("double")))


def safe_date(x: Column | Val) -> Column:
    x = _val(x)
    s10 = F.substring(x.s, 1, 10)
    return F.when(_is_string(x) & s10.rlike(_DATE_TEXT), F.try_to_date(s10, "yyyy-M-d"))


def safe_timestamp(x: Column | Val) -> Column:
    """Date-time text as a timestamp (session zone UTC), else NULL."""
    x = _val(x)
    return F.when(_is_string(x), F.try_to_timestamp(x.s))


def safe_bool(x: Column | Val) -> Column:
    x = _val(x)
    word = F.lower(_strip(as_string(x)))
    return (F.when(x.k == BOOLEAN, F.try_variant_get(x.v, "$", "boolean"))
            .otherwise(F.coalesce(word.isin(*TRUE_WORDS), F.lit(False))))


def truthy(x: Column | Val) -> Column:
    x = _val(x)
    if x.t is not None:
        return x.t
    k = x.k
    return (F.when(is_missing(x), F.lit(False))
            .when(k == STRING, x.s != "")
            .when(k == BOOLEAN, F.try_variant_get(x.v, "$", "boolean"))
            .when(_is_number(x), F.try_variant_get(x.v, "$", "double") != 0)
            .otherwise(F.lit(True)))


def text(x: Column | Val) -> Column:
    """``value or None`` stored as text."""
    x = _val(x)
    return F.when(truthy(x), as_string(x))


def text_if_present(x: Column | Val) -> Column:
    """``str(value) if value is not None``."""
    x = _val(x)
    return F.when(~is_missing(x), as_string(x))


def first_truthy(*xs: Column | Val) -> Val:
    """``a or b or ...`` over raw values; the chosen raw value and its kind."""
    vals = [_val(x) for x in xs]
    v, k, s = vals[-1].v, vals[-1].k, vals[-1].s
    for x in reversed(vals[:-1]):
        t = truthy(x)
        v = F.when(t, x.v).otherwise(v)
        k = F.when(t, x.k).otherwise(k)
        s = F.when(t, x.s).otherwise(s)
    return Val(v, k, s)
