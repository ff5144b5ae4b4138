"""Names of uploaded files."""

import string
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

KEPT = string.ascii_letters + string.digits + "_.-"
# Everything that separates words of a name: the slash and what str.split() splits at.
BLANKS = "/" + "".join(c for c in map(chr, range(128)) if c.isspace() and c != " ")
DROPPED = "".join(c for c in map(chr, range(128)) if c not in KEPT + BLANKS + " ")


def file_extension(name: Column) -> Column:
    """Text after the last dot in lower case; NULL where there is no dot."""
    return F.when(F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1)))


@F.pandas_udf(StringType())
def _fold_to_ascii(names: pd.Series) -> pd.Series:
    return names.map(
        lambda n: unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode("ascii"),
        na_action="ignore",
    )


def clean_filename(name: Column) -> Column:
    """A name that is safe as one path component.

    Accents are folded away, slashes and runs of blanks become one underscore, any
    other character outside letters, digits, dot, dash and underscore is dropped,
    and dots and underscores at both ends are stripped. Only names with a character
    outside ASCII travel to Python.
    """
    foreign = F.when(F.octet_length(name) > F.length(name), name)
    folded = F.coalesce(_fold_to_ascii(foreign), name)
    spaced = F.regexp_replace(F.translate(folded, BLANKS, " " * len(BLANKS)), " {2,}", " ")
    return F.trim(F.translate(spaced, " " + DROPPED, "_"), F.lit("._"))
