"""Raw text log -> typed log (P1-P8), one ``select`` so Catalyst fuses it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import clean_text, parse_date, title_case, to_bigint_key, to_double


def rename_known(df: DataFrame, rename=K.COLUMN_RENAME) -> DataFrame:
    """Keep the known headers under their new names; absent ones are skipped."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in rename.items()
                       if src in df.columns])


def clean_raw(df: DataFrame, rename=K.COLUMN_RENAME, na_strings=K.NA_STRINGS,
              keep=()) -> DataFrame:
    """P1-P8 in one projection.

    Input: all-string columns with raw headers (the CSV scan).  The missing
    texts are recognised before the trim (as the CSV reader does), then every
    string is trimmed of all white space and blanks become NULL; dates,
    numbers and the key are coerced (bad values -> NULL), the never-inspected
    date becomes NULL, flags and areas are title-cased and grades upper-cased.
    ``keep`` passes extra columns (e.g. a source-order id) through unchanged.
    """
    out = []
    for src, dst in rename.items():
        if src not in df.columns:
            continue
        s = clean_text(F.col(f"`{src}`"), na_strings)
        if dst in K.DATE_COLUMNS:
            v = parse_date(s)
            if dst == "inspection_date":
                v = F.nullif(v, F.lit(K.NEVER_INSPECTED_DATE).cast("date"))
        elif dst == "camis":
            v = to_bigint_key(s)
        elif dst in K.NUMERIC_COLUMNS:
            v = to_double(s)
        elif dst in ("critical_flag", "boro"):
            v = title_case(s)
        elif dst == "grade":
            v = F.upper(s)
        else:
            v = s
        out.append(v.alias(dst))
    return df.select(*out, *[F.col(c) for c in keep])
