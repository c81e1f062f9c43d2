from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: White space as a character class: ASCII and the Unicode spaces that saved
#: pages carry (the no-break ones are not in \s).
SPACE = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u0085\u001c-\u001f]"


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")
