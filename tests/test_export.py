"""The export job: going on after a failure, and owning its stages."""

from __future__ import annotations

import os
import threading

import pytest

from test_orders_values import _one_erp

from tabsmith.plans import export, tabs
from tabsmith.session import shared_dir


@pytest.fixture(scope="module")
def erp(spark, tmp_path_factory):
    """A folder of small ERP tables."""
    folder = tmp_path_factory.mktemp("erp")
    for name, df in _one_erp(spark).items():
        df.limit(200).write.parquet(str(folder / name))
    return str(folder)


def files_of(folder):
    """{path: time of change} of the data files of every tab."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def stage_folders(spark):
    folder = f"{shared_dir(spark)}/stages"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_rerun_goes_on_after_the_failed_tab(spark, erp, tmp_path, monkeypatch):
    out, before = str(tmp_path / "out"), stage_folders(spark)
    built = []
    real = {name: getattr(tabs, name) for name in ("assembly_inventory_tab", "active_purchased_items", "latest_units", "assembly_items_kept",
                                                   "customer_universe", "selected_boms")}

    def counted(name):
        def build(*args, **kwargs):
            built.append(name)
            return real[name](*args, **kwargs)
        return build

    for name in real:
        monkeypatch.setattr(tabs, name, counted(name))

    def broken(*args, **kwargs):
        raise RuntimeError("the ninth tab fails")

    monkeypatch.setattr(tabs, "assembly_inventory_tab", broken)
    with pytest.raises(RuntimeError, match="ninth"):
        export.export_all(export.read_tables(spark, erp), out, "parquet")
    written = files_of(out)
    finished = {os.path.relpath(p, out).split(os.sep)[0] for p in written}
    assert finished == set(list(export.TAB_ORDER)[:8])
    assert built.count("active_purchased_items") == built.count("latest_units") == built.count("assembly_items_kept") == 1
    assert len(stage_folders(spark) - before) == 1  # the export's own, with three item stages and the universe

    monkeypatch.setattr(tabs, "assembly_inventory_tab", real["assembly_inventory_tab"])
    built.clear()
    paths = export.export_all(export.read_tables(spark, erp), out, "parquet")
    assert list(paths) == list(export.TAB_ORDER)
    assert all(files_of(out)[p] == t for p, t in written.items())  # the first eight tabs were not written again
    assert built == ["selected_boms"]  # committed stages were read back
    assert stage_folders(spark) == before and not os.listdir(f"{out}/_export")

    fresh = str(tmp_path / "fresh")
    export.export_all(export.read_tables(spark, erp), fresh, "parquet")
    for name in ("customers", "assemblies", "assembly_item_vendors", "routing_steps"):
        rows = [sorted(map(str, spark.read.parquet(f"{folder}/{name}").collect())) for folder in (out, fresh)]
        assert rows[0] == rows[1], name


def test_other_options_or_inputs_start_afresh(spark, erp, tmp_path):
    read = export.read_tables(spark, erp)
    keys = {export.ExportRun(spark, str(tmp_path / "out"), read, options).key for options in ({"fmt": "csv"}, {"fmt": "parquet"})}
    keys.add(export.ExportRun(spark, str(tmp_path / "elsewhere"), read, {"fmt": "csv"}).key)
    read["arinvt"].write.parquet(str(tmp_path / "arinvt"))
    rewritten = {**read, "arinvt": spark.read.parquet(str(tmp_path / "arinvt"))}
    keys.add(export.ExportRun(spark, str(tmp_path / "out"), rewritten, {"fmt": "csv"}).key)
    assert len(keys) == 4
    assert export.ExportRun(spark, str(tmp_path / "out"), read, {"fmt": "csv"}).key in keys


def test_two_exports_side_by_side(spark, erp, tmp_path):
    before, failures = stage_folders(spark), []

    def run(name):
        try:
            export.export_all(export.read_tables(spark, erp), str(tmp_path / name), "parquet")
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=run, args=(name,)) for name in ("one", "two")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures and stage_folders(spark) == before
    for name in export.TAB_ORDER:
        rows = [sorted(map(str, spark.read.parquet(str(tmp_path / out / name)).collect())) for out in ("one", "two")]
        assert rows[0] == rows[1], name


def test_fresh_ignores_marks(spark, erp, tmp_path):
    out = str(tmp_path / "out")
    run = export.ExportRun(spark, out, export.read_tables(spark, erp), {"fmt": "parquet", "legacy_names": False, "values": None})
    for name in export.TAB_ORDER:
        run.commit(f"tab-{name}")
        os.makedirs(f"{out}/{name}")
    export.export_all(export.read_tables(spark, erp), out, "parquet")
    assert not files_of(out)  # every tab was marked
    for name in export.TAB_ORDER:
        run.commit(f"tab-{name}")
    export.export_all(export.read_tables(spark, erp), out, "parquet", fresh=True)
    assert {os.path.relpath(p, out).split(os.sep)[0] for p in files_of(out)} == set(export.TAB_ORDER)
