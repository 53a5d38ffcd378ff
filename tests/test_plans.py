"""Plan checks: pushdown, pruning and join choices the design relies on."""

from conftest import SF_SMALL
from stratal.plans.sales import recent_sales
from stratal.sources.standins import (AS_OF, MONTHS, PLANT_MAP, SKU_BELOW, TX_TYPES, VALID_AFTER,
                                      standin_tables)
from stratal.sources.tables import load_tables


def _plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_sales_window_and_types_reach_the_fact_scan(spark, capsys):
    t = standin_tables(load_tables(spark, SF_SMALL))
    plan = _plan(recent_sales(t, AS_OF, MONTHS, TX_TYPES, PLANT_MAP, VALID_AFTER, SKU_BELOW), capsys)
    scan = plan[plan.index("Location: InMemoryFileIndex [file:/root/testdata/sf0.001/lineitem.parquet]"):]
    pushed = scan[scan.index("PushedFilters"):].splitlines()[0]
    schema = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "In(l_linenumber, [2,3,4,5,6])" in pushed
    # only the five columns the query uses are read
    assert schema.split("struct<")[1].count(":") == 5 and "l_extendedprice" not in schema


def test_sales_pre_aggregate_before_the_joins(spark, capsys):
    t = standin_tables(load_tables(spark, SF_SMALL))
    plan = _plan(recent_sales(t, AS_OF, MONTHS, TX_TYPES, PLANT_MAP, VALID_AFTER, SKU_BELOW), capsys)
    blocks = plan.split("\n\n")
    partial = [b for b in blocks if ") HashAggregate" in b and "partial_sum(cajas_fisicas" in b]
    # one partial aggregate on (location, product) only: the pre-join combine of the fact rows
    assert any("Keys [2]: [id_localidad" in b and "id_prod" in b for b in partial)


def test_only_sales_of_active_products_are_shuffled(spark, capsys):
    t = standin_tables(load_tables(spark, SF_SMALL))
    plan = _plan(recent_sales(t, AS_OF, MONTHS, TX_TYPES, PLANT_MAP, VALID_AFTER, SKU_BELOW), capsys)
    tree = plan[:plan.index("\n\n(")].splitlines()
    fact = max(i for i, x in enumerate(tree) if "Scan parquet" in x and "lineitem" in plan.split(
        f"({x.rsplit('(', 1)[1].rstrip(')')}) Scan parquet")[1][:1200].split("Location")[1][:200])
    above = [x for x in tree[:fact]][::-1]
    depth = lambda x: len(x) - len(x.lstrip(" +-:*"))
    path, level = [], depth(tree[fact])
    for x in above:  # the operators from the fact scan upwards
        if depth(x) < level:
            path.append(x)
            level = depth(x)
    first_exchange = next(i for i, x in enumerate(path) if " Exchange " in x)
    assert any("LeftSemi" in x for x in path[:first_exchange])
    # nothing about products is inferred onto the fact scan but the key's presence
    scan = plan[plan.index("sf0.001/lineitem.parquet"):]
    assert "l_partkey)" in scan.splitlines()[1] and "1500" not in scan[:400]


def test_integer_sku_bound_reaches_the_scan(spark, capsys, tmp_out):
    from stratal.operators.predicates import active_products

    for kind in ("bigint", "int", "double"):
        spark.sql(f"SELECT CAST(5 AS {kind}) sku, 'N' suprimido, CAST(NULL AS DATE) fech_supr, date'2001-01-01' ffin_vreg"
                  ).write.mode("overwrite").parquet(f"{tmp_out}/{kind}")
        df = active_products(spark.read.parquet(f"{tmp_out}/{kind}"), "2000-01-01", 7.5)
        assert "LessThan(sku," in _plan(df, capsys).split("PushedFilters")[1].splitlines()[0]
        assert df.count() == 1


def test_relation_without_order_has_no_sort(spark, capsys):
    from stratal.plans.family import family_relation

    fam = spark.range(5).selectExpr("CAST(id AS INT) familyid", "CAST(id AS INT) parentid")
    assert "Sort" in _plan(family_relation(fam), capsys)
    assert "Sort" not in _plan(family_relation(fam, ordered=False), capsys)


def test_product_lookups_are_broadcast_when_small(spark, capsys):
    from stratal.plans.products import product_master

    t = standin_tables(load_tables(spark, SF_SMALL))
    plan = _plan(product_master(t, VALID_AFTER, SKU_BELOW), capsys)
    assert plan.count("BroadcastHashJoin LeftOuter") == 6
    assert "SortMergeJoin" not in plan


def test_category_lookup_becomes_inner_in_the_family_path(spark, capsys):
    from stratal.plans.family import sales_products
    from stratal.plans.products import product_master
    from stratal.sources.standins import CATEGORY

    t = standin_tables(load_tables(spark, SF_SMALL))
    pm = product_master(t, VALID_AFTER, SKU_BELOW, with_flavour=False)
    rs = recent_sales(t, AS_OF, MONTHS, TX_TYPES, PLANT_MAP, VALID_AFTER, SKU_BELOW)
    blocks = _plan(sales_products(rs, pm, CATEGORY), capsys).split("\n\n")
    joins = {}
    for b in blocks:
        lines = b.strip().splitlines()
        if lines and "Join" in lines[0] and "Right keys" in b:
            right = b[b.index("Right keys"):].splitlines()[0]
            kind = b[b.index("Join type: "):].splitlines()[0].split(": ")[1]
            joins[right] = kind
    by_key = {k.split("__k0_")[1].split("#")[0]: v for k, v in joins.items() if "__k0_" in k}
    # the equality filter on the category rejects nulls, so the optimizer turns that lookup inner
    assert by_key == {"id_marca": "LeftOuter", "id_tamano": "LeftOuter", "id_tipo_empaque": "LeftOuter",
                      "id_catego": "Inner", "id_tipo_consum": "LeftOuter"}
