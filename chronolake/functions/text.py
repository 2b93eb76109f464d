"""Text functions without a built-in form."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def nfkc(text: Column) -> Column:
    """Unicode NFKC in Arrow batches; pure ASCII texts pass unchanged."""
    def run(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))

    return F.pandas_udf(run, StringType())(text)


def normalized_text(text: Column) -> Column:
    """NFKC without control characters, some full-width marks folded; lines with single spaces, empty lines gone."""
    out = F.regexp_replace(nfkc(text), r"[\p{C}&&[^\n\r\t]]", "")
    out = F.translate(out, "，：（）／−—", ",:()/--")
    lines = F.transform(F.split(out, r"\r\n|[\n\r]"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")
