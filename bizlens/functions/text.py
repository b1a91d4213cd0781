"""Text functions (H17-H24, H29-H33) and value parsers used by cleaning.

All are Column -> Column expressions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Missing-value markers of the cleaning job (explicit list first,
# then the pandas read_csv defaults it keeps).
NA_MARKERS = ["N/A", "null", "none", "NA", "-", "",
              "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
              "1.#QNAN", "<NA>", "NULL", "NaN", "None", "n/a", "nan"]

# Rating words of the product listing.
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}


def na_to_null(c: Column, markers=NA_MARKERS) -> Column:
    """A1: exact, case-sensitive marker match (before any trimming) becomes NULL."""
    return F.when(c.isin(*markers), F.lit(None).cast("string")).otherwise(c)


# The white space of text cells (Unicode's, and the ASCII separators 1C-1F).
WHITE = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
# The same characters one by one.
WHITE_CHARS = "\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202F\u205F\u3000"
# A plain number with an exponent if any; casts alone take type suffixes, hexadecimal and NaN.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def squeeze(s: Column) -> Column:
    """Trim and collapse inner whitespace runs to one space; no-break and other Unicode spaces are white space.

    A cell of visible ASCII characters alone stays as it is, which a look at its characters tells."""
    return F.when(s.rlike("[^!-~]"), F.trim(F.regexp_replace(s, WHITE + "+", " "))).otherwise(s)


def strip(s: Column) -> Column:
    """White space of all kinds off both ends."""
    return F.btrim(s, F.lit(WHITE_CHARS))


def plain_number(s: Column) -> Column:
    """The number that a text spells out, else NULL."""
    v = strip(s)
    return F.when(v.rlike(PLAIN_NUMBER), v.try_cast("double"))


def excel_trim(s: Column) -> Column:
    """H17 (spreadsheet TRIM): only the space character is collapsed."""
    return F.regexp_replace(F.regexp_replace(s, " +", " "), "^ | $", "")


def proper(s: Column) -> Column:
    """Title case like Python ``str.title`` / spreadsheet PROPER.

    Every run of letters is capitalised on its first letter and lower-cased
    after it; anything else is a separator (``men's`` -> ``Men'S``).  Built
    from code-generated expressions only: a marker and a space are put before
    every letter that follows a non-letter, ``initcap`` (which capitalises
    after spaces) does the casing, and the markers are removed again.  The text's own
    markers are doubled meanwhile, so none of them is taken for one put in.
    """
    marked = F.regexp_replace(F.replace(F.lower(s), F.lit("\u0001"), F.lit("\u0001\u0001")), r"([^\p{L}])(\p{L})", "$1\u0001 $2")
    # left to right: a doubled marker is the text's own, a marker and a space were put in
    return F.regexp_replace(F.initcap(marked), "\u0001(?:(\u0001)| )", "$1")


def left(s: Column, n: int) -> Column:
    """H20 LEFT."""
    return F.substring(s, 1, n)


def right(s: Column, n: int) -> Column:
    """H20 RIGHT."""
    return F.when(F.length(s) <= n, s).otherwise(F.substring(s, -n, n))


def mid(s: Column, start: int, length: int) -> Column:
    """H20 MID (1-based)."""
    return F.substring(s, start, length)


def find(needle: str, s: Column) -> Column:
    """H20 FIND: 1-based position, NULL when absent (the spreadsheet shows #VALUE!)."""
    pos = F.instr(s, needle)
    return F.when(pos > 0, pos)


def text_before(s: Column, sep: str) -> Column:
    """``LEFT(s, FIND(sep, s) - 1)``; NULL when sep is absent."""
    return F.when(F.instr(s, sep) > 0, F.substring_index(s, sep, 1))


def substitute(s: Column, old: str, new: str) -> Column:
    """H21 SUBSTITUTE: every occurrence."""
    return F.replace(s, F.lit(old), F.lit(new))


def excel_concat(*parts) -> Column:
    """H22 ``&``: blanks count as empty text."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def text_join(sep: str, *cols: Column) -> Column:
    """H22 TEXTJOIN(sep, TRUE, …): skips NULLs."""
    return F.concat_ws(sep, *cols)


def price_number(s: Column) -> Column:
    """H23, first step: strip ``$`` and ``,``, parse."""
    return plain_number(F.translate(s, "$,", ""))


def valid_price(v: Column) -> Column:
    """H23, second step: negative -> NULL."""
    return F.when(v >= 0, v)


def parse_price(s: Column) -> Column:
    """Strip ``$`` and ``,``, parse, negative or unparsable -> NULL."""
    return valid_price(price_number(s))


def valid_quantity(v: Column, lo: float = 0, hi: float = 1000) -> Column:
    """Outside [lo, hi] -> NULL, round half to even, integer."""
    return F.bround(F.when((v >= lo) & (v <= hi), v), 0).cast("long")


def parse_quantity(s: Column, lo: float = 0, hi: float = 1000) -> Column:
    """H24 + B13: parse, outside [lo, hi] -> NULL, round half to even, integer."""
    return valid_quantity(plain_number(s), lo, hi)


def rating_value(word: Column) -> Column:
    """Rating word -> number, unknown -> 0."""
    m = F.create_map(*[x for k, v in RATING_WORDS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, word), F.lit(0))


def human_size(n_bytes: Column) -> Column:
    """1024-based size text with one decimal (bytes below 1 KB)."""
    b = n_bytes.cast("double")
    kb, mb, gb = 1024.0, 1024.0 ** 2, 1024.0 ** 3
    return (F.when(b >= gb, F.concat(F.format_number(b / gb, 1), F.lit(" GB")))
             .when(b >= mb, F.concat(F.format_number(b / mb, 1), F.lit(" MB")))
             .when(b >= kb, F.concat(F.format_number(b / kb, 1), F.lit(" KB")))
             .otherwise(F.concat(n_bytes.cast("long").cast("string"), F.lit(" bytes"))))


def money_text(x: Column, symbol: str = "$") -> Column:
    """``$1,234.50`` (presentation only; keep the numeric column too)."""
    return F.when(x < 0, F.concat(F.lit("-" + symbol), F.format_number(-x, 2))) \
            .otherwise(F.concat(F.lit(symbol), F.format_number(x, 2)))


def percent_text(x: Column, digits: int = 1) -> Column:
    """Fraction -> ``12.3%``."""
    return F.concat(F.format_number(x * 100, digits), F.lit("%"))


def safe_name(file_name: Column, idx: Column, max_len: int = 31) -> Column:
    """Drop the extension, replace ``\\ / * [ ] : ?`` by ``_``, prefix the index, cut."""
    base = F.regexp_replace(file_name, r"\.[^.]*$", "")
    base = F.regexp_replace(base, r"[\\/*\[\]:?]", "_")
    return F.substring(F.concat(idx.cast("string"), F.lit("_"), base), 1, max_len)


def status_label(x: Column, ok: str = "On Track", bad: str = "Over Budget") -> Column:
    """Sign of a variance as a label."""
    return F.when(x >= 0, ok).otherwise(bad)


def is_valid_email(s: Column) -> Column:
    """The schema's e-mail CHECK (case-insensitive)."""
    # Fixed value: the pattern of the CHECK.
    return s.rlike(r"(?i)^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$")
