"""Command line argument handling (the run itself is covered end to end)."""

import pytest

from tillroll.cli import layer_paths, parse_args


def test_root_layout():
    p = layer_paths(parse_args(["gate", "--root", "/w/", "--dataset", "shop"]))
    assert p.bronze("orders") == "/w/clean/shop/bronze/orders"


def test_explicit_bases():
    p = layer_paths(parse_args(["all", "--raw", "s3a://raw", "--clean", "s3a://clean/shop",
                                "--mart", "s3a://mart/shop"]))
    assert p.gold("mart_daily_sales") == "s3a://mart/shop/gold/mart_daily_sales"


def test_missing_bases_rejected(monkeypatch):
    for v in ("RAW_BASE_PATH", "CLEAN_BASE_PATH", "MART_BASE_PATH"):
        monkeypatch.delenv(v, raising=False)
    with pytest.raises(SystemExit, match="missing base paths"):
        layer_paths(parse_args(["bronze"]))


def test_env_bases(monkeypatch):
    monkeypatch.setenv("RAW_BASE_PATH", "/r")
    monkeypatch.setenv("CLEAN_BASE_PATH", "/c")
    monkeypatch.setenv("MART_BASE_PATH", "/m/")
    assert layer_paths(parse_args(["gold"])).gold("x") == "/m/gold/x"


def test_unknown_stage_rejected():
    with pytest.raises(SystemExit):
        parse_args(["platinum", "--root", "/w"])


def test_scale_conf_sizes_partitions():
    from tillroll.session import scale_conf
    conf = scale_conf(100 * 10**12)
    assert conf["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (200 << 20)))
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "1"


def test_shuffle_bytes_flag():
    assert parse_args(["all", "--root", "/w", "--shuffle-bytes", "1e12"]).shuffle_bytes == 1e12


def test_cli_runs_every_stage(spark, smoke_dir, tmp_path, capsys):
    import json

    from tillroll.cli import main
    from tillroll.paths import LayerPaths
    from tillroll.sources.driver_tables import DriverTables
    from tillroll.sources.landing import land_tables

    paths = LayerPaths.under(str(tmp_path))
    land_tables(DriverTables(spark, smoke_dir).bronze(), paths)
    assert main(["all", "--root", str(tmp_path)]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["result"]
    assert report["gate"] == {"valid": 1475, "quarantined": 55}
    assert spark.read.parquet(paths.gold("mart_daily_sales")).count() > 0
