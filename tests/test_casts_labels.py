from stratal.functions.casts import lenient_int
from stratal.functions.labels import lookup_map, product_labels
from stratal.plans.family import family_id


def test_lenient_int_matches_legacy_cast(spark):
    df = spark.createDataFrame([(v,) for v in ["12.7", "12", "-12.7", "A12", "7000123456", " 5 ", None]], "s string")
    got = [r[0] for r in df.select(lenient_int("s")).collect()]
    assert got == [12, 12, -12, None, None, 5, None]


def test_lenient_int_truncates_like_the_legacy_cast(spark):
    texts = ["12.9999999999", "0.99999999999", "-0.99999999999", "-12.5", ".5", "5.", ".", "-", "+", "", " ", "+7", "-.9",
             "1e5", "1.2.3", "12a", "2147483647.9", "2147483648", "-2147483648.99", "\t8\n", "00012", "1_0", "٣",
             "9" * 60, "1." + "9" * 60]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(lenient_int("s")).collect()]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert got == [r[0] for r in df.selectExpr("cast(s as int)").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_lenient_int_of_numbers_truncates(spark):
    row = spark.sql("SELECT 1.9999999999D a, -1.9999999999D b, CAST(7.99 AS DECIMAL(20,10)) c, 7000123456L d, 3e10D e, 5 f, "
                    "true g, CAST('NaN' AS DOUBLE) h")
    got = row.select(*[lenient_int(c) for c in row.columns]).first()
    assert list(got) == [1, -1, 7, None, None, 5, 1, None]
    assert row.select(lenient_int("d", "bigint"), lenient_int("e", "bigint")).first() == (7000123456, 30_000_000_000)


def test_lenient_bigint_keeps_large_values(spark):
    df = spark.createDataFrame([("7000123456",)], "s string")
    assert df.select(lenient_int("s", "bigint")).first()[0] == 7000123456


def test_family_id_overflow_is_null(spark):
    df = spark.createDataFrame([(3, 100000), (2, 100000), (1, 5), (None, 5), (4, None), (2, 1000000)],
                               "p int, r long")
    got = [r[0] for r in df.select(family_id("p", "r")).collect()]
    assert got == [None, 2000100000, 10005, None, None, None]
    wide = [r[0] for r in df.select(family_id("p", "r", "bigint")).collect()]
    assert wide[0] == 3000100000


def test_null_concat_argument_gives_null_label_but_name_is_built(spark):
    df = spark.createDataFrame(
        [("M", None, "T1", "E1", "G1", "C1", "S1", 6)],
        "desc_marca string, azucar string, desc_tamano string, desc_tipo_empaque string, "
        "desc_tipo_empaque_gen string, desc_tipo_consum_corto string, desc_sabor string, bote int")
    row = df.withColumns(product_labels()).first()
    assert row["marcamkt"] is None
    assert row["name_concat_general"] == "M T1 E1"
    assert row["name_concat"] == "M S1 T1 E1 BOTELLAS: 6"
    assert row["formato"] == "G1-C1"


def test_sugar_free_label_branch(spark):
    df = spark.createDataFrame(
        [("M", "SIN AZUCAR", "T1", "E1", "G1", "C1", "S1", 6), ("M", "sin azucar", "T1", "E1", "G1", "C1", "S1", 6)],
        "desc_marca string, azucar string, desc_tamano string, desc_tipo_empaque string, "
        "desc_tipo_empaque_gen string, desc_tipo_consum_corto string, desc_sabor string, bote int")
    names = [r["name_concat_general"] for r in df.withColumns(product_labels()).collect()]
    assert names == ["M SIN AZUCAR T1 E1", "M T1 E1"]  # LIKE is case-sensitive


def test_lookup_map_without_else(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "k string")
    got = [r[0] for r in df.select(lookup_map("k", {"A": 1})).collect()]
    assert got == [1, None, None]
