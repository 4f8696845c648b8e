"""Scalar rules X1-X11 on hand-made urls (decisions D1, D3, D4, D10)."""

from pyspark.sql import functions as F

from sitelens.functions import scalars as X


def _eval(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_state_for_grouping_is_case_sensitive(spark):
    urls = ["https://www.cidade.sp.gov.br/", "https://WWW.CIDADE.SP.GOV.BR/",
            "https://cidade.gov.br/", "https://x.rj.gov.br.evil.com/"]
    assert _eval(spark, urls, X.state_from_url) == ["SP", "", "", "RJ"]


def test_state_label_lower_cases_and_marks_missing(spark):
    urls = ["https://WWW.CIDADE.SP.GOV.BR/", "https://cidade.gov.br/", None]
    assert _eval(spark, urls, X.state_label) == ["SP", "N/A", "N/A"]


def test_site_name_rules(spark):
    urls = [
        "https://www.saopaulo.sp.gov.br/",       # www and .gov.br removed
        "https://Camara.RJ.gov.br:8080/x",       # lower case, port dropped
        "http://user@www.cidade_x.mg.gov.br",    # user info and '_' in host
        "https://a.www.b.com.br.gov.br/",        # every www. removed, both suffixes
        "https://cidade.org.br",                 # .org.br
        "not a url",                             # no host -> url itself
    ]
    assert _eval(spark, urls, X.site_name) == [
        "saopaulo.sp", "camara.rj", "cidade_x.mg", "a.b", "cidade", "not a url"]


def test_normalize_url_adds_exactly_one_slash(spark):
    assert _eval(spark, ["https://a.gov.br", "https://a.gov.br/", "https://a.gov.br///"],
                 X.normalize_url) == ["https://a.gov.br/"] * 3


def test_is_valid_url(spark):
    urls = ["https://a.gov.br", "http://x", "not_a_url", "", None, "ftp://h/p", "https://"]
    assert _eval(spark, urls, X.is_valid_url) == [True, True, False, False, False, True, False]


def test_score_percent_null_and_zero(spark):
    vals = [None, 0.0, 0.57, 0.255]
    mobile = _eval(spark, vals, lambda c: X.score_percent(c), "v double")
    desktop = _eval(spark, vals, lambda c: X.score_percent(c, null_as_zero=False), "v double")
    assert mobile == [0.0, 0.0, 57.0, 25.5]
    assert desktop == [None, 0.0, 57.0, 25.5]


def test_bands_and_badges(spark):
    assert _eval(spark, [0.95, 0.9, 0.5, 0.49, None], X.score_band, "v double") == \
        ["good", "good", "ok", "bad", None]
    assert _eval(spark, [80.0, 79.9, 60.0, 10.0], X.badge_text, "v double") == \
        ["Excelente", "Bom", "Bom", "Precisa Melhorar"]
    assert _eval(spark, [80.0, 60.0, 0.0], X.badge_class, "v double") == \
        ["excellent", "good", "poor"]


def test_iso_text_like_python(spark):
    import datetime as dt
    ts = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120)]
    out = _eval(spark, ts, X.iso_text, "v timestamp_ntz")
    assert out == [t.isoformat() for t in ts]


def test_status_mark(spark):
    assert _eval(spark, [None, "boom"], X.status_mark) == ["✅", "❌"]


def test_sql_functions_equal_the_column_rules(spark):
    import datetime as dt
    from sitelens.plans.sql import register_functions
    spark.catalog.dropTempView("audit_summaries")
    register_functions(spark)
    urls = ["https://www.cidade1.sp.gov.br/x", "http://u:p@WWW.A.RJ.GOV.BR:80/", "https://x.org.br.com.br//", "no url", "", None,
            "ftp://www.www.a.gov.br?x", "https://", "https://a.gov.br.org.br", "HTTP://a/b\n", "https://x.sp.gov.br.mg.gov.br/"]
    numbers = [None, 0.0, 0.4999, 0.5, 0.89999, 0.9, 1.0, 0.0525, 60.0, 79.99, 80.0, -0.001]
    times = [None, dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60)]
    rows = [(urls[i % len(urls)], numbers[i % len(numbers)], times[i % 3]) for i in range(len(urls) * len(numbers))]
    df = spark.createDataFrame(rows, "url string, x double, t timestamp_ntz")
    pairs = {f"{n}(url)": getattr(X, n)("url") for n in ("state_from_url", "state_label", "site_name", "normalize_url", "is_valid_url")}
    pairs |= {f"{n}(x)": getattr(X, n)("x") for n in ("score_percent", "score_band", "badge_class", "badge_text")}
    pairs |= {"iso_text(t)": X.iso_text("t"), "audit_day(t)": X.day("t"), "status_mark(url)": X.status_mark("url")}
    for sql, rule in pairs.items():
        wrong = df.select("url", "x", "t", F.expr(sql).alias("a"), rule.alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
        assert wrong.collect() == [], sql
