"""Readings on hand-made frames."""

import datetime as dt

from bloomline.operators import readings, weekly


def test_short_years_are_stretched(spark):
    rows = [(2020, w, 10.0, 5.0, f"a{w}") for w in range(1, 53)] + [(2021, w, 10.0, 5.0, f"b{w}") for w in (1, 2)]
    lines = spark.createDataFrame(rows, "iso_year int, iso_week int, stems_confirmed double, sales_usd double, order_id string")
    found = {r.iso_year: r for r in readings.year_projection(lines).collect()}
    assert (found[2020].projected_stems, found[2020].orders) == (520.0, 52)
    assert (found[2021].stems, found[2021].projected_stems, found[2021].projected_price) == (20.0, 520.0, 0.5)


def test_only_whole_windows_start(spark):
    weeks = spark.createDataFrame([(2020, w) for w in (1, 2, 3, 5, 6)], "iso_year int, iso_week int")
    found = sorted((r.size, r.first_week) for r in readings.validation_windows(weeks, (2, 3)).collect())
    assert found == [(2, 1), (2, 2), (2, 5), (3, 1)]


def test_inventory_match_falls_back_to_color(spark):
    day = dt.date(2020, 1, 6)
    wanted = spark.createDataFrame([(day, "rosa", "v1", "rojo", "60", 5.0), (day, "rosa", "v2", "rojo", "60", 7.0), (day, "rosa", "v1", "azul", "60", 1.0)], "order_date date, product string, variety string, color string, grade string, stems double")
    there = spark.createDataFrame([(day, "rosa", "v1", "rojo", "60", -3.0), (day, "rosa", "v9", "rojo", "50", 10.0)], "inv_date date, product string, variety string, color string, grade string, balance double")
    found = sorted((r.variety, r.color, r.match, r.balance) for r in readings.flexible_inventory_match(wanted, there).collect())
    assert found == [("v1", "azul", "SIN_MATCH", None), ("v1", "rojo", "EXACTO", -3.0), ("v2", "rojo", "FLEXIBLE", 7.0)]


def test_reasons_are_shared_values_only(spark):
    columns = "client_code string, client string, stems double, product string, color string, order_type string, stems_per_bunch string, sleeve string, packaging string"
    rows = [("1", "a", 9.0, "rosa", "rojo", "SOLIDO", "25", "sin_info", "qb"), ("2", "b", 5.0, "rosa", "azul", "BULK", "10", "sin_info", "hb"), ("3", "c", 5.0, "lirio", "verde", "BQT", "12", "x", "fb")]
    pairs = spark.createDataFrame([("1", "a", "2", "b"), ("1", "a", "3", "c")], "client_code string, client string, similar_code string, similar_client string")
    found = {r.similar_code: r.reasons for r in readings.similarity_reasons(pairs, spark.createDataFrame(rows, columns)).collect()}
    assert found == {"2": "product: rosa", "3": readings.NO_REASON}


def test_every_key_has_the_weeks_ahead(spark):
    monday = dt.date(2020, 12, 21)
    rows = [("c", "m", "x", "rosa", "rojo", monday, 5.0), ("c", "m", "x", "rosa", "azul", monday - dt.timedelta(28), 5.0)]
    demand = spark.createDataFrame(rows, "client string, market string, country string, product string, color string, week_start date, stems double")
    found = weekly.future_weeks(demand, 3).collect()
    assert len(found) == 6 and {(r.iso_year, r.iso_week) for r in found} == {(2020, 53), (2021, 1), (2021, 2)}
    assert {r.week_start for r in found} == {monday + dt.timedelta(7 * k) for k in (1, 2, 3)}
