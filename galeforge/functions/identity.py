"""Storm identity: names, identifiers, episode keys."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BASINS = ("AL", "EP", "CP")
_PATTERN = "^[A-Z0-9]+(-[A-Z0-9]+)*$"


def storm_identity(identifier: Column, long_name: Column) -> Column:
    """The trimmed long name, else the identifier, trimmed; null if both are empty."""
    return F.coalesce(F.nullif(F.trim(long_name), F.lit("")), F.trim(identifier))


def is_named_storm(name: Column) -> Column:
    """False for ids of one or two characters and for two digits and a letter, after trimming."""
    t = F.trim(name)
    return (F.length(t) > 2) & ~t.rlike("^[0-9]{2}[A-Za-z]$")


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def normalize_identifier(identifier: Column) -> tuple[Column, Column]:
    """(value, error): NFKC, trimmed, upper-cased; null with a reason where it breaks a rule.

    Only rows with other characters than ASCII go to Python, for the normal form.
    """
    plain = F.when(identifier.rlike(r"^[\x00-\x7F]*$"), identifier).otherwise(_nfkc(F.when(~identifier.rlike(r"^[\x00-\x7F]*$"), identifier)))
    t = F.btrim(plain, F.lit("  　 "))
    error = (
        F.when(identifier.isNull(), "missing")
        .when(plain.rlike(r"[\x00-\x1f\x7f-\x9f]"), "control characters")
        .when(t == "", "empty")
        .when(~t.rlike(r"^[\x00-\x7F]*$"), "not ASCII")
        .when(~F.upper(t).rlike(_PATTERN), "bad pattern")
    )
    return F.when(error.isNull(), F.upper(t)), error


def episode_key(producer: str, basin: Column, season: Column, identifier: Column) -> Column:
    """A struct of producer, basin, season, identifier where the basin is known, the season in 2000..9999 and the identifier valid; else null."""
    value, _ = normalize_identifier(identifier)
    ok = basin.isin(*BASINS) & season.between(2000, 9999) & value.isNotNull()
    return F.when(ok, F.struct(F.lit(producer).alias("producer"), basin.alias("basin"), season.alias("season"), value.alias("identifier")))
