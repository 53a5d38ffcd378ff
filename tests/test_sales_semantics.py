import datetime as dt

from stratal.plans.sales import recent_sales

T2 = dt.datetime(2025, 6, 1)


def test_pre_aggregation_equals_join_then_group_with_duplicate_keys(spark):
    day = dt.date(2025, 5, 20)
    # product 1 is hot: a third of the fact rows; product 2 appears twice in the product snapshot,
    # location 20 twice in the location snapshot (one with another group name)
    sales = [(10, 1, 1.0, day, 9)] * 30 + [(20, 2, 2.0, day, 10)] * 20 + [(10, 3, 5.0, day, 11)] * 40 + \
            [(10, 1, 7.0, day, 99), (30, 2, 1.0, dt.date(2024, 1, 1), 9)]
    h_ventas = spark.createDataFrame(sales, "id_localidad long, id_prod long, cajas_fisicas double, fecha date, "
                                            "id_tipo_transaccion int")
    prod_rows = [(1, "N", None, dt.date(2026, 1, 1), "5", T2), (2, "N", None, dt.date(2026, 1, 1), "6", T2),
                 (2, "N", None, dt.date(2026, 1, 1), "6", T2), (3, "N", None, dt.date(2026, 1, 1), "7", T2)]
    d_prod = spark.createDataFrame(prod_rows, "id_prod long, suprimido string, fech_supr date, ffin_vreg date, "
                                              "sku string, process_timestamp timestamp_ntz")
    d_localidad = spark.createDataFrame(
        [(10, "A", T2), (20, "B", T2), (20, "C", T2), (30, "A", T2)],
        "id_localidad long, agru_local string, process_timestamp timestamp_ntz")
    tables = {"h_ventas": h_ventas, "d_prod": d_prod, "d_localidad": d_localidad}
    got = recent_sales(tables, "2025-06-01", 3, [9, 10, 11], {"A": 1, "B": 2}, "2025-01-01", 3000)

    # units per (place, product) in the window: (10, 1) 30, (20, 2) 40, (10, 3) 200; product 2 is in the snapshot
    # twice, so its sum doubles; place 20 has two group names; (30, 2) is too old, (10, 1, 7.0) of another type
    assert sorted(map(tuple, got.collect())) == [
        (10, "A", 1, 30.0, day, 1), (10, "A", 3, 200.0, day, 1),
        (20, "B", 2, 80.0, day, 2), (20, "C", 2, 80.0, day, None)]


def test_decimal_measure_keeps_the_type_of_a_single_sum(spark):
    day = dt.date(2025, 5, 20)
    tables = {
        "h_ventas": spark.sql(f"SELECT 1L id_localidad, 1L id_prod, CAST(2.50 AS DECIMAL(10,2)) cajas_fisicas, "
                              f"date'{day}' fecha, 9 id_tipo_transaccion"),
        "d_prod": spark.sql("SELECT 1L id_prod, 'N' suprimido, CAST(NULL AS DATE) fech_supr, date'2026-01-01' ffin_vreg, "
                            "'5' sku, timestamp_ntz'2025-06-01 00:00:00' process_timestamp"),
        "d_localidad": spark.sql("SELECT 1L id_localidad, 'A' agru_local, timestamp_ntz'2025-06-01 00:00:00' process_timestamp"),
    }
    got = recent_sales(tables, "2025-06-01", 3, [9], {"A": 1}, "2025-01-01", 3000)
    assert dict(got.dtypes)["cajas_fisicas"] == "decimal(20,2)"
    assert got.first()["cajas_fisicas"] == 2.5
