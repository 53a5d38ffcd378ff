import __spark_entry__ as E


def test_entry_runs_on_smallest_tables(spark):
    df = E.entry(spark)
    assert df.count() == 18
    assert df.columns == ["idplanta", "id_prod", "sku", "familyid", "agru_local", "categoria", "marcamkt",
                          "formato", "formatomkt", "cantsubunidades", "sku_padre"]


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_scale_settings():
    from stratal.session import scale_settings

    s = scale_settings(8000, 100 << 40)
    assert s["spark.sql.shuffle.partitions"] == str(100 * 4 * 1024) and s["spark.sql.adaptive.enabled"] == "true"
    assert scale_settings(8)["spark.sql.shuffle.partitions"] == "24"
