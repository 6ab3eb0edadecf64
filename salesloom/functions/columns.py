"""Column expressions for cleaning and standardising text extracts.

Everything here is built from JVM-side functions, so it stays inside
whole-stage code generation and never aborts on dirty input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: must equal the source system for right results ------------
TAX_ID_WIDTH = 14
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
YES = "S"
CANCELLED_STATUS = "Cancelado"
PAID_STATUS = "Pago"
STAGE_NAMES = {"Fechado ganho": "Ganha", "Fechado perdido": "Perdida"}
STAGE_WON = "Ganha"
STAGE_LOST = "Perdida"
ORDER_WORD = "pedido"
MISSING_SEGMENT = "Nao informado"
MISSING_CITY = "Nao informada"
MISSING_STATE = "N/A"
MISSING_DISTRICT = "Nao informado"
MISSING_BRAND = "Sem marca"
# -----------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tax_id_digits(c: str | Column) -> Column:
    """The digits of a tax id, everything else removed."""
    return F.regexp_replace(F.trim(_col(c)), "[^0-9]", "")


def normalise_tax_id(c: str | Column, width: int = TAX_ID_WIDTH) -> Column:
    """Digits only, left padded with zeros (longer input is cut to ``width``)."""
    return F.lpad(tax_id_digits(c), width, "0")


def tax_id_valid(c: str | Column, width: int = TAX_ID_WIDTH) -> Column:
    """True where the id has between 1 and ``width`` digits before padding."""
    return F.coalesce(F.length(tax_id_digits(c)).between(1, width), F.lit(False))


def normalise_name(c: str | Column) -> Column:
    """Trimmed, first letters upper case, runs of blanks collapsed."""
    return F.regexp_replace(F.initcap(F.trim(_col(c))), " +", " ")


def parse_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses, NULL if none does; never raises under ANSI mode.

    The ISO format uses the parser without a pattern, which also takes
    timestamps and single-digit months.
    """
    text = F.trim(_col(c))
    attempts = [
        F.try_to_date(text) if fmt == "yyyy-MM-dd" else F.try_to_date(text, fmt) for fmt in formats
    ]
    return attempts[0] if len(attempts) == 1 else F.coalesce(*attempts)


def flag(c: str | Column, true_value: str = YES) -> Column:
    """True for ``true_value`` (trimmed); anything else, NULL included, is False."""
    return F.coalesce(F.trim(_col(c)) == true_value, F.lit(False))


def net_value(total: str | Column, cancelled: str | Column) -> Column:
    """Zero for cancelled rows; negative totals are kept."""
    return F.when(_col(cancelled), F.lit(0)).otherwise(_col(total))


def map_values(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    column = _col(c)
    chain = reduce(
        lambda acc, kv: acc.when(column == kv[0], kv[1]),
        list(mapping.items())[1:],
        F.when(column == next(iter(mapping)), mapping[next(iter(mapping))]),
    )
    return chain.otherwise(column)


def try_number(c: str | Column, type_name: str) -> Column:
    """Typed number, NULL where the text is not one."""
    return F.trim(_col(c)).try_cast(type_name)


def default(c: str | Column, value: object) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def year_month(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM`` label."""
    return F.concat(
        F.lpad(_col(year).cast("string"), 4, "0"), F.lit("-"),
        F.lpad(_col(month).cast("string"), 2, "0"),
    )


def month_start(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM-01`` label, the x axis of monthly charts."""
    return F.concat(year_month(year, month), F.lit("-01"))


def safe_ratio(
    num: str | Column, den: str | Column, scale: int = 1, digits: int | None = None
) -> Column:
    """``num / den * scale`` as double, NULL on a zero denominator.

    With ``digits`` the division is done in decimals (inputs of at most 20 digits
    before and 4 after the point) and rounded half up, without in double.
    """
    num, den = _col(num), _col(den)
    if digits is None:
        ratio = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
        return ratio if scale == 1 else ratio * F.lit(float(scale))
    exact = "decimal(24,4)"
    ratio = num.cast(exact) / F.nullif(den.cast(exact), F.lit(Decimal(0)))
    if scale != 1:
        # a literal of few digits leaves the product its decimal places
        ratio = ratio * F.lit(Decimal(scale))
    return F.round(ratio, digits).cast("double")


def money(c: str | Column, digits: int = 2) -> Column:
    """Exact decimal rounded half up, then handed out as double."""
    return F.round(_col(c), digits).cast("double")


def optional_filter(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Apply only the predicates that carry a value; lists mean membership.

    NULL values in ``wanted`` stand for "all", the sentinel of dashboard filters.
    """
    for name, value in wanted.items():
        if value is None:
            continue
        if isinstance(value, (list, tuple, set)):
            df = df.where(F.col(name).isin(*value))
        else:
            df = df.where(F.col(name) == F.lit(value))
    return df
