"""Narrow and wide frames give the same rows, also with orphan lines."""

import shutil

from conftest import SF

from saleswh.plans.tables import sales_flat, sales_star


def test_same_rows_with_orphans(spark, tmp_path):
    for name in ("region", "nation", "customer", "orders", "part", "lineitem"):
        shutil.copyfile(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    spark.read.parquet(f"{SF}/part.parquet").filter("p_partkey % 7 != 0").write.parquet(str(tmp_path / "p"))
    shutil.copyfile(next((tmp_path / "p").glob("*.parquet")), tmp_path / "part.parquet")
    sf = str(tmp_path)
    wide = sales_flat(spark, sf).count()
    assert 0 < wide < spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert sales_flat(spark, sf, ["sales"]).count() == sales_flat(spark, sf, ["city", "sales"]).count() == wide
    assert sales_star(spark, sf).flat(["sales"]).count() == wide
