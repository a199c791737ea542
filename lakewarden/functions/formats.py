"""Date and time formats: strftime directives and the list of accepted date layouts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Directive -> (Spark pattern beside a separator, Spark pattern beside
# another number, shape of the text, and whether it is a number).
DIRECTIVES = {
    "Y": ("yyyy", "yyyy", r"[0-9]{4}", True),
    "y": ("yy", "yy", r"[0-9]{2}", True),
    "m": ("M", "MM", r"[0-9]{1,2}", True),
    "d": ("d", "dd", r"[0-9]{1,2}", True),
    "H": ("H", "HH", r"[0-9]{1,2}", True),
    "I": ("h", "hh", r"[0-9]{1,2}", True),
    "M": ("m", "mm", r"[0-9]{1,2}", True),
    "S": ("s", "ss", r"[0-9]{1,2}", True),
    "f": ("SSSSSS", "SSSSSS", r"[0-9]{1,6}", True),
    "j": ("D", "DDD", r"[0-9]{1,3}", True),
    "b": ("MMM", "MMM", r"[A-Za-z]{3}", False),
    "B": ("MMMM", "MMMM", r"[A-Za-z]+", False),
    "p": ("a", "a", r"[AaPp][Mm]", False),
}

# Layouts taken as dates besides what a plain cast accepts.
DATE_LAYOUTS = [
    "yyyy/M/d",
    "yyyy/M/d H:m:s",
    "yyyy.M.d",
    "yyyyMMdd",
    "yyyyMMddHHmmss",
    "M/d/yyyy",
    "M/d/yyyy H:m",
    "M/d/yyyy H:m:s",
    "M/d/yyyy h:m a",
    "M-d-yyyy",
    "d.M.yyyy",
    "d.M.yyyy H:m:s",
    "d MMM yyyy",
    "d MMMM yyyy",
    "d-MMM-yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "MMM d yyyy",
    "MMMM d yyyy",
]


class UnsupportedFormat(ValueError):
    """A strftime directive that has no Spark pattern."""


def strftime_parts(fmt: str) -> tuple[str, str]:
    """(Spark datetime pattern, regular expression for the shape) of a strftime format."""
    parts = re.findall(r"%(.)|([^%]+)", fmt)
    if "".join("%" + d if d else text for d, text in parts) != fmt:
        raise UnsupportedFormat(f"unsupported format: {fmt}")
    pattern, shape = "", "^"
    for i, (directive, text) in enumerate(parts):
        if directive == "%":
            directive, text = "", "%"
        if text:
            quoted = text.replace("'", "''") + "'"
            # Two quotes in a row would stand for a quote character: join the literals.
            pattern = pattern[:-1] + quoted if pattern.endswith("'") else pattern + "'" + quoted
            shape += "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)
            continue
        if directive not in DIRECTIVES:
            raise UnsupportedFormat(f"unsupported directive: %{directive}")
        around = [parts[k][0] for k in (i - 1, i + 1) if 0 <= k < len(parts)]
        tight = any(a in DIRECTIVES and DIRECTIVES[a][3] for a in around)
        loose, fixed, text_shape, number = DIRECTIVES[directive]
        pattern += fixed if tight and number else loose
        shape += text_shape
    return pattern, shape + "$"


def matches_strftime(text: Column, fmt: str) -> Column:
    """TRUE where the text is a valid date or time of the given strftime format."""
    pattern, shape = strftime_parts(fmt)
    return text.rlike(shape) & F.try_to_timestamp(text, F.lit(pattern)).isNotNull()


def parse_date(text: Column) -> Column:
    """The text as a timestamp, by a plain cast or the first layout that fits."""
    layouts = [F.try_to_timestamp(F.trim(text), F.lit(p)) for p in DATE_LAYOUTS]
    return F.coalesce(F.trim(text).try_cast("timestamp"), *layouts)
