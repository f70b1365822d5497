from bloomline.operators import cleaning


def kinds(spark, rows, reference=None):
    names = cleaning.TYPE_FIELDS
    data = [tuple([x] + ["sin_info"] * (len(names) - 1)) + ((reference,) if reference else ()) for x in rows]
    schema = ", ".join(f"{n} string" for n in names) + (", reference_type string" if reference else "")
    return [r.order_type for r in cleaning.classify_order_type(spark.createDataFrame(data, schema)).collect()]


def test_precedence(spark):
    rows = ["combo solido", "rainbow combo", 'surtido "m"', "bulk", "nothing", "solido por color", "mixed", "bqt rainbow"]
    assert kinds(spark, rows) == ["COMBO", "COMBO", "SURTIDO_M", "BULK", "OTRO_NO_CLASIFICADO", "SOLIDO", "SURTIDO", "BQT"]


def test_reference_beats_general_marks_only(spark):
    assert kinds(spark, ["solido", "rainbow", "nothing"], "bulk") == ["BULK", "RAINBOW", "BULK"]


def test_clean_orders_of_an_empty_table(spark):
    raw = spark.createDataFrame([], "FECHA date, CODCUSTOM string, CLIENTE string, PRODUCTO string, TallosPedidos string, ESTADO string")
    assert cleaning.clean_orders(raw).count() == 0
