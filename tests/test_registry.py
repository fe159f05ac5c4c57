from featuremap.plans.registry import positive_zero_rounding


def test_round_calls_get_positive_zero():
    sql = "SELECT round((a - b) / c, 6) AS x, myround(q), ROUND(avg(round(z, 2)), 3) y FROM t"
    out = positive_zero_rounding(sql)
    assert "(round((a - b) / c, 6) + 0.0) AS x" in out
    assert "myround(q)" in out
    assert "(ROUND(avg((round(z, 2) + 0.0)), 3) + 0.0) y" in out


def test_statement_without_round_unchanged():
    sql = "SELECT a FROM t"
    assert positive_zero_rounding(sql) == sql
