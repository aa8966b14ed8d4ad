"""Column-expression helpers (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions import constants as K


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- cleaning (P2-P8) --------------------------------------------------------

#: The characters of the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def trim_all_space(c: str | Column) -> Column:
    """Strip every kind of white space at both ends (``trim`` only strips blanks);
    each end is looked at once, however many blanks lie inside."""
    return F.btrim(col_(c), F.lit(WHITE_SPACE))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col_(c), F.lit(""))


def na_text_to_null(c: str | Column, na_strings=K.NA_STRINGS) -> Column:
    cc = col_(c)
    return F.when(cc.isin(*na_strings), F.lit(None).cast("string")).otherwise(cc)


def clean_text(c: str | Column, na_strings=K.NA_STRINGS) -> Column:
    """Missing texts and blank ones to NULL, the others trimmed of all white space, in
    one step: a text whose first and last characters are plain ones (after the blank and
    before U+0085, where no white space lies) stays as it is and is not searched."""
    cc = col_(c)
    plain = lambda x: F.ascii(x).between(0x21, 0x84)
    return F.when(cc.isin(*na_strings), F.lit(None).cast("string")) \
            .when(plain(cc) & plain(F.substring(cc, -1, 1)), cc).otherwise(blank_to_null(trim_all_space(cc)))


def parse_date(c: str | Column, fmt: str = K.DATE_FORMAT) -> Column:
    """Lenient date parse; a bad value becomes NULL."""
    return F.try_to_date(col_(c), fmt)


def to_double(c: str | Column) -> Column:
    """Numeric coerce; bad text and NaN become NULL."""
    return F.nanvl(col_(c).try_cast("double"), F.lit(None).cast("double"))


def to_bigint_key(c: str | Column) -> Column:
    return to_double(c).try_cast("bigint")


def title_case(c: str | Column) -> Column:
    """Upper-case every letter that follows no letter, lower-case the others
    (so words split at blanks, hyphens, apostrophes and digits alike)."""
    runs = F.regexp_extract_all(F.lower(col_(c)), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


# --- encodings (P9, P17, P20) -------------------------------------------------

def grade_encode(c: str | Column) -> Column:
    m = F.create_map(*[x for g, v in K.GRADE_TO_INT.items() for x in (F.lit(g), F.lit(float(v)))])
    return m[col_(c)]


def grade_safety(c: str | Column) -> Column:
    m = F.create_map(*[x for g, v in K.SAFETY_SCORES.items() for x in (F.lit(g), F.lit(v))])
    return m[col_(c)]


def score_to_label(score: str | Column, a_cut: float = 2.5, b_cut: float = 1.5) -> Column:
    s = col_(score)
    return F.when(s >= a_cut, "A").when(s >= b_cut, "B").otherwise("C")


def grade_colour(c: str | Column) -> Column:
    m = F.create_map(*[x for g, v in K.GRADE_COLOR_RGBA.items()
                       for x in (F.lit(g), F.array(*[F.lit(i) for i in v]))])
    return F.coalesce(m[col_(c)], F.array(*[F.lit(i) for i in K.NO_GRADE_RGBA]))


def address(building: str | Column = "building", street: str | Column = "street") -> Column:
    """building + ' ' + street, trimmed; missing parts count as ''."""
    return F.trim(F.concat(F.coalesce(col_(building), F.lit("")), F.lit(" "),
                           F.coalesce(col_(street), F.lit(""))))


# --- grid geometry (G1, G2, G9, G15) ------------------------------------------

def lat_to_row(lat: str | Column) -> Column:
    r = ((col_(lat) - F.lit(K.LAT_MIN)) / F.lit(K.GRID_LAT_RES)).cast("int")
    return F.least(F.greatest(r, F.lit(0)), F.lit(K.GRID_ROWS - 1))


def lng_to_col(lng: str | Column) -> Column:
    c = ((col_(lng) - F.lit(K.LNG_MIN)) / F.lit(K.GRID_LNG_RES)).cast("int")
    return F.least(F.greatest(c, F.lit(0)), F.lit(K.GRID_COLS - 1))


def row_to_lat(row: str | Column) -> Column:
    return F.lit(K.LAT_MIN) + (col_(row) + F.lit(0.5)) * F.lit(K.GRID_LAT_RES)


def col_to_lng(c: str | Column) -> Column:
    return F.lit(K.LNG_MIN) + (col_(c) + F.lit(0.5)) * F.lit(K.GRID_LNG_RES)


def in_bbox(lat: str | Column, lng: str | Column) -> Column:
    return (col_(lat).between(K.LAT_MIN, K.LAT_MAX)
            & col_(lng).between(K.LNG_MIN, K.LNG_MAX))


def flat_distance_km(lat1, lng1, lat2, lng2) -> Column:
    dy = (col_(lat1) - col_(lat2)) * F.lit(K.METRES_PER_DEG_LAT)
    dx = (col_(lng1) - col_(lng2)) * F.lit(K.METRES_PER_DEG_LNG)
    return F.sqrt(dy * dy + dx * dx) / F.lit(1000.0)


def hop_km(dr: Column, dc: Column) -> Column:
    a = F.abs(dr) * F.lit(K.METRES_PER_ROW)
    b = F.abs(dc) * F.lit(K.METRES_PER_COL)
    return F.sqrt(a * a + b * b) / F.lit(1000.0)


def walk_minutes(km: str | Column) -> Column:
    return col_(km) / F.lit(K.WALK_SPEED_KMH) * F.lit(60.0)


# --- text (T1, T2, T11) --------------------------------------------------------

def normalise_name(c: str | Column) -> Column:
    """lower, drop ASCII punctuation, collapse white space, trim."""
    punct = "[" + "".join("\\" + ch for ch in K.ASCII_PUNCTUATION) + "]"
    s = F.regexp_replace(F.lower(col_(c)), punct, "")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    return trim_all_space(s)


def char_wb_grams(text: str | Column, n_min: int = 2, n_max: int = 4) -> Column:
    """Word-bounded character n-grams (array<string>).

    Each white-space separated word is padded with one blank per side; grams
    of length n..m never cross words; a padded word shorter than n yields
    itself once.
    """
    words = F.filter(F.split(col_(text), r"(?U)\s+"), lambda w: F.length(w) > 0)
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    def grams_of(n: int):
        # one-argument lambda: a second parameter would receive the index
        def f(w):
            short = F.array(w) if n == n_min else F.array().cast("array<string>")
            slide = F.transform(F.sequence(F.lit(1), F.length(w) - F.lit(n - 1)),
                                lambda i: F.substring(w, i, n))
            return F.when(F.length(w) < n, short).otherwise(slide)
        return f

    per_n = [F.flatten(F.transform(padded, grams_of(n))) for n in range(n_min, n_max + 1)]
    return F.flatten(F.array(*per_n))


def rounded(x: Column, digits: int) -> Column:
    """``F.round`` of a double, to the bit, without its way through a decimal text: where
    what follows the last place is clearly no half, the nearest whole number of places
    is the same number.  All other values (large ones, NaN) go to ``F.round``."""
    y = x * F.lit(10.0 ** digits)
    clear = (F.abs(y) < F.lit(1e13)) & (F.abs(y - F.floor(y) - F.lit(0.5)) > F.lit(0.01))
    return F.when(clear, F.floor(y + F.lit(0.5)).cast("double") / F.lit(10.0 ** digits)).otherwise(F.round(x, digits))
