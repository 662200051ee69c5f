"""Label parsers for the free-text invoice description (Column -> Column, no UDF).

Two families exist because the two source programs parse the same text
differently:

* the *line* form (description monitor): a regular expression per label whose
  ``\\s*`` may cross a line break, so an empty ``Competencia:`` captures the
  next line;
* the *positional* form (settlement script): text after the label up to the
  first CR/LF inside a 50-character window, trimmed of spaces.

Labels match case-sensitively unless ``ignore_case`` is set.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: description labels -------------------------------------
COMPETENCE_LABEL = "Competencia:"
DUE_LABEL = "Vencimento:"
DPD_LABEL = "DPD:"
TITLE_LABEL = "NN:"
TITLE_FALLBACK_LABEL = "Titulo:"
#: width of the window read after a date label by the positional form
POSITIONAL_WINDOW = 50
#: width of the window read after the DPD label by the positional form
DPD_WINDOW = 20
#: what follows a label: the rest of its line, a signed number, a run of digits and signs
REST_OF_LINE, SIGNED_NUMBER, DIGITS_AND_SIGNS = r"\s*([^\r\n]+)", r"\s*(-?\d+)", r"^[0-9\-]*"
# ---------------------------------------------------------------------------


def _flags(ignore_case: bool) -> str:
    return "(?i)" if ignore_case else ""


def _contains(text: Column, label: str, ignore_case: bool) -> Column:
    if ignore_case:
        return F.lower(text).contains(label.lower())
    return text.contains(label)


def _locate(text: Column, label: str, ignore_case: bool) -> Column:
    """1-based position of the first ``label`` in ``text``; 0 when absent."""
    if ignore_case:
        return F.locate(label.lower(), F.lower(text))
    return F.locate(label, text)


# --------------------------------------------------------------------------
# line form (description monitor)
# --------------------------------------------------------------------------
def label_line(text: Column, label: str, ignore_case: bool = False) -> Column:
    """Trimmed rest of the line after ``label`` (``''`` when the label is absent)."""
    pattern = _flags(ignore_case) + re.escape(label) + REST_OF_LINE
    return F.trim(F.regexp_extract(text, pattern, 1))


def dpd_line(text: Column, ignore_case: bool = False) -> Column:
    """Signed integer after ``DPD:``; NULL when missing or out of int range."""
    pattern = _flags(ignore_case) + re.escape(DPD_LABEL) + SIGNED_NUMBER
    return F.regexp_extract(text, pattern, 1).try_cast("int")


# --------------------------------------------------------------------------
# positional form (settlement script)
# --------------------------------------------------------------------------
def title_code(text: Column, ignore_case: bool = False, strip_cr: bool = False) -> Column:
    """Title code: text after ``NN:``, else after ``Titulo:``, up to the next LF.

    The cut stops at LF only, so CRLF text keeps a trailing CR unless
    ``strip_cr`` is set; spaces are trimmed on both ends.  NULL when neither
    label occurs.
    """
    stop = r"\r\n" if strip_cr else r"\n"
    flags = _flags(ignore_case)

    def after(label: str) -> Column:
        return F.trim(F.regexp_extract(text, flags + re.escape(label) + f"([^{stop}]*)", 1))

    return (
        F.when(_contains(text, TITLE_LABEL, ignore_case), after(TITLE_LABEL))
        .when(_contains(text, TITLE_FALLBACK_LABEL, ignore_case), after(TITLE_FALLBACK_LABEL))
    )


def label_window(text: Column, label: str, width: int = POSITIONAL_WINDOW,
                 ignore_case: bool = False) -> Column:
    """Text after ``label`` up to the first CR/LF within ``width`` characters, trimmed.

    Like the positional original, a missing label reads from position
    ``len(label)`` (locate gives 0).
    """
    start = _locate(text, label, ignore_case) + F.lit(len(label))
    window = text.substr(start, F.lit(width))
    return F.trim(F.regexp_extract(window, r"^[^\r\n]*", 0))


def dpd_window(text: Column, empty_as_zero: bool = True, ignore_case: bool = False) -> Column:
    """Days past due read positionally after ``DPD:``.

    Takes ``DPD_WINDOW`` characters after the label, strips leading spaces,
    keeps the leading run of digits and minus signs and converts it to int
    (NULL when that fails).  The original's integer conversion turns an empty
    run or a bare sign into 0; ``empty_as_zero=False`` gives NULL instead.
    """
    start = _locate(text, DPD_LABEL, ignore_case) + F.lit(len(DPD_LABEL))
    rest = F.ltrim(text.substr(start, F.lit(DPD_WINDOW)))
    digits = F.regexp_extract(rest, DIGITS_AND_SIGNS, 0)
    parsed = digits.try_cast("int")
    if not empty_as_zero:
        return parsed
    return F.when(digits.isin("", "-"), F.lit(0)).otherwise(parsed)


def digits_only_length(text: Column) -> Column:
    """Length after removing ``. - /`` and spaces (document-number punctuation)."""
    return F.length(F.translate(text, ".-/ ", ""))


def document_type(text: Column) -> Column:
    """``CNPJ`` for more than 11 significant characters, else ``CPF`` (NULL -> CPF)."""
    return F.when(digits_only_length(text) > 11, F.lit("CNPJ")).otherwise(F.lit("CPF"))
