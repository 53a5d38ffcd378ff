from conftest import SF_SMALL
from stratal.sources.standins import standin_tables
from stratal.sources.tables import TEST_TABLES, load_tables, read_table, register_views


def test_read_by_name_and_by_path(spark, tmp_out):
    base = load_tables(spark, SF_SMALL)
    register_views({"stratal_nation": base["nation"]})
    assert read_table(spark, "stratal_nation").count() == 25
    base["nation"].write.option("header", "true").csv(tmp_out)
    typed = read_table(spark, tmp_out, "csv", "n_nationkey int, n_name string, n_regionkey int", {"header": "true"})
    assert typed.dtypes == [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]
    assert typed.count() == 25


def test_tables_open_on_first_use(spark):
    base = load_tables(spark, SF_SMALL)
    assert list(base) == list(TEST_TABLES) and len(base) == len(TEST_TABLES)
    assert base["part"] is base["part"]  # opened once
    stand = standin_tables(base)
    assert set(stand) == {"d_prod", "d_marca", "d_tamano", "d_tipo_empaque", "d_sabor", "d_categoria",
                          "d_tipo_consum", "d_localidad", "h_ventas"}
    assert stand["d_prod"].count() == 400
