"""Layer path resolution."""

import pytest

from tillroll.paths import LayerPaths


@pytest.fixture()
def paths():
    return LayerPaths("s3a://raw", "s3a://clean/shop", "s3a://mart/shop", "shop")


@pytest.fixture()
def slashed():
    return LayerPaths("s3a://raw/", "s3a://clean/shop/", "s3a://mart/shop/", "shop")


def test_raw_path(paths):
    assert paths.raw("orders.csv") == "s3a://raw/shop/latest/orders.csv"


def test_raw_path_snapshot(paths):
    assert paths.raw("orders.csv", "archive/run_ts=1") == "s3a://raw/shop/archive/run_ts=1/orders.csv"


def test_bronze_path(paths):
    assert paths.bronze("orders") == "s3a://clean/shop/bronze/orders"


def test_silver_path(paths):
    assert paths.silver("stg_orders") == "s3a://clean/shop/silver/stg_orders"


def test_gold_path(paths):
    assert paths.gold("mart_daily_sales") == "s3a://mart/shop/gold/mart_daily_sales"


@pytest.mark.parametrize("layer,table", [("raw", "orders.csv"), ("bronze", "orders"),
                                         ("silver", "stg_orders"), ("gold", "mart_daily_sales")])
def test_trailing_slash_normalised(slashed, layer, table):
    assert "//" not in slashed.layer(layer, table).replace("s3a://", "")


def test_layer_dispatch_matches_methods(paths):
    assert paths.layer("silver", "x") == paths.silver("x")


def test_unknown_layer_rejected(paths):
    with pytest.raises(ValueError, match="platinum"):
        paths.layer("platinum", "x")


def test_under_root():
    p = LayerPaths.under("/data/", "shop")
    assert p.bronze("orders") == "/data/clean/shop/bronze/orders"
    assert p.gold("m") == "/data/mart/shop/gold/m"
    assert p.raw("f.csv") == "/data/raw/shop/latest/f.csv"


def test_default_dataset_folder():
    from tillroll.schemas import DATASET_FOLDER
    assert LayerPaths.under("/d").raw("f.csv") == f"/d/raw/{DATASET_FOLDER}/latest/f.csv"
