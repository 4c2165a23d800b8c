"""Row order of the queries that sort: the comparison with SQL looks at rows alone."""

from tidemark.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def rows(spark, name, folder=FOLDER):
    found = [tuple(r) for r in QUERIES[name](spark, folder).collect()]
    assert len(found) > 1
    return found


def test_sort_multi(spark):
    got = rows(spark, "sort_multi")
    assert got == sorted(got, key=lambda r: (r[0], -r[1], r[2]))


def test_sort_nulls_last(spark):
    got = rows(spark, "sort_nulls_last")
    assert got == sorted(got, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got[-1][1] is None and got[0][1] is not None


def test_scan_sql(spark):
    prices = [r[2] for r in rows(spark, "scan_sql", "/root/testdata/sf0.1")]
    assert prices == sorted(prices)


def test_alias_sort_expr(spark):
    got = rows(spark, "alias_sort_expr")
    assert got == sorted(got, key=lambda r: (-r[1], r[0]))


def test_value_counts(spark):
    got = rows(spark, "value_counts")
    assert got == sorted(got, key=lambda r: (-r[1], r[0]))


def test_years_listed(spark):
    got = rows(spark, "years_listed")
    assert got == sorted(got)
