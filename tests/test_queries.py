"""Every registered query of the point-in-time part against its SQL."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from chronolake.plans import catalog
from compare import connect, same_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outcomes(spark):
    """Queries run side by side; what went wrong with each, or None."""
    con = connect(SF)

    def run(name):
        try:
            same_rows(catalog.QUERIES[name](spark, SF), con.cursor(), catalog.ORACLE_SQL[name])
        except Exception as e:
            return e

    names = sorted(catalog.ORACLE_SQL)
    with ThreadPoolExecutor(6) as pool:
        return dict(zip(names, pool.map(run, names)))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(outcomes, name):
    if outcomes[name] is not None:
        raise outcomes[name]


def test_flagship(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and all(0 <= r["is_advance_ratio"] <= 1 for r in rows if r["is_advance_ratio"] is not None)


def test_text_normalisation_matches_unicodedata(spark):
    import unicodedata

    from pyspark.sql import functions as F

    from chronolake.functions.text import normalized_text

    texts = ["ＡＢＣ　１２３", "plain", None, "a\u200bb  c\r\n\n x\x07", "（注）—"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalized_text(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in rows] == ["ABC 123", "plain", None, "ab c\nx", "(注)-"]
    assert unicodedata.normalize("NFKC", texts[0]).split() == ["ABC", "123"]
