"""Every query of the library against its SQL twin."""

from __future__ import annotations

import pandas as pd
import pytest

from tallyspark.plans import catalogue
from tests.conftest import DATA, rows_of


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = df.select(*(df[c].cast("string") if t in ("bigint", "int") else df[c] for c, t in df.dtypes)).toPandas()
    if name in catalogue.SQL:
        want = duck.execute(catalogue.SQL[name]).df()
        for c in want:
            if str(want[c].dtype).startswith(("float", "Int", "int")) and got[c].dtype == object:
                want[c] = pd.Series([None if pd.isna(x) else int(x) for x in want[c]], dtype=object)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    else:
        assert len(got) > 0


def test_entry(spark):
    import __spark_entry__

    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
