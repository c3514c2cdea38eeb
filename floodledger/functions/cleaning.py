"""Safe casts and text normalisation of raw string columns.

The casts to numbers check the text against a pattern first: a safe cast that fails raises and
catches an exception inside the engine, which on dirty columns costs far more than the pattern.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodledger.schemas import MISSING_TOKENS

MONEY = "decimal(18,2)"
WHOLE = r"^[+-]?\d{1,18}$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def blank_to_null(col: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """NULL where the text is one of the missing tokens (case matters)."""
    return F.when(~col.isin(list(tokens)), col)


def normalise_missing(df: DataFrame, tokens: Iterable[str] = MISSING_TOKENS) -> DataFrame:
    """Apply ``blank_to_null`` to every string column."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank_to_null(F.col(c), tokens) for c in texts})


def code(col: Column) -> Column:
    """Trimmed upper-case code without the ``.0`` a float column leaves behind."""
    text = F.upper(F.trim(col))
    return F.when(text.contains("."), F.regexp_replace(text, r"^(\d+)\.0+$", "$1")).otherwise(text)


def to_date(col: Column) -> Column:
    """A date from text that starts with a whole ISO date, else NULL.

    The plain cast would also read ``2017`` as the first of January.
    """
    text = F.trim(col)
    return F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.substring(text, 1, 10).try_cast("date")
    )


def to_money(col: Column) -> Column:
    """A two-digit decimal; unusable or missing text counts as zero."""
    text = F.trim(col)
    amount = F.when(text.rlike(NUMBER), text.try_cast(MONEY))
    return F.coalesce(amount, F.lit(0).cast(MONEY))


def to_number(col: Column) -> Column:
    """A double, NULL for other text."""
    text = F.trim(col)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def whole(text: Column) -> Column:
    """An integer from text without decimals, else NULL."""
    return F.when(text.rlike(WHOLE), text.try_cast("int"))


def to_int(col: Column) -> Column:
    return whole(code(col))


def or_unknown(col: Column) -> Column:
    return F.coalesce(col, F.lit("Unknown"))
