import __spark_entry__ as entry


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"mean_ndvi", "ts_lower", "ts_upper", "climatology"} <= set(rows[0].asDict())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100
