"""Produce every tab in one job, in the order the scripts ran.

Intermediates read by several tabs (the customer universe, the active purchased
items, the kept assemblies, the latest purchase units, the selected BOMs and
the BOM main table) are written once as stages below the cluster's shared
folder and read back: later tabs reuse them instead of recomputing, and a lost
executor re-reads files instead of re-running the upstream plan. Every finished
tab and stage is marked, so that an export that failed goes on where it stopped
(:class:`ExportRun`); marks and stages go when all tabs are written.

    python -m tabsmith.plans.export <tables folder> <output folder> [options]

The tables folder holds one parquet table per ERP table name (``tabs.TABLES``),
in any store that Spark reads. See ``--help`` for cut-off dates, excluded ids,
template values and format.
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
import json
import sys
from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tabsmith.plans import tabs
from tabsmith.session import create_mark, path_exists, remove_stage, shared_dir
from tabsmith.sources.files import collected_stages, read_stage, staged, write_csv

# Tab name -> export order key (see tabs.SINK_ORDER); None: the tab comes sorted by a column it doesn't have.
TAB_ORDER = {
    "customers": "customer", "customer_bill_to": "customer_address", "customer_ship_to": "customer_address",
    "customer_addresses": "customer_address", "vendors": "vendor", "purchased_items": "purchase_inventory",
    "purchased_locations": "purchase_inventory", "purchased_item_vendors": "purchase_item_vendors",
    "assemblies": "assembly_inventory", "assembly_locations": None, "assembly_item_vendors": "assembly_item_vendors",
    "bills_of_materials": "bom_header", "bom_revisions": None, "bom_revision_components": "bom_components",
    "assembly_bom_links": "bom_link", "routings": None, "routing_steps": "routing_steps",
}

#: A stage by name: committed before, or built and written now.
StageOf = Callable[[str, Callable[[], DataFrame]], DataFrame]
Builders = dict[str, Callable[[], DataFrame]]


def _once(stage: StageOf, name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
    """The stage, written when the first tab needs it."""
    return cache(lambda: stage(name, build))


def _write_now(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return staged(build(), name)


def _customer(t: Mapping[str, DataFrame], stage: StageOf, **address_options) -> Builders:
    universe = _once(stage, "customer_universe", lambda: tabs.customer_universe(t))
    return {
        "customers": lambda: tabs.customer_tab(t, universe()),
        "customer_bill_to": lambda: tabs.customer_address_tab(t, "bill_to", **address_options),
        "customer_ship_to": lambda: tabs.customer_address_tab(t, "ship_to", **address_options),
        "customer_addresses": lambda: tabs.customer_own_address_tab(t, universe()),
    }


def _vendor(t: Mapping[str, DataFrame], **vendor_options) -> Builders:
    return {"vendors": lambda: tabs.vendor_tab(t, **vendor_options)}


def _item(t: Mapping[str, DataFrame], stage: StageOf, purchased: dict | None, assembly: dict | None) -> Builders:
    units = _once(stage, "latest_units", lambda: tabs.latest_units(t))
    items = _once(stage, "active_purchased_items", lambda: tabs.active_purchased_items(t, **(purchased or {})))
    kept = _once(stage, "assembly_items_kept", lambda: tabs.assembly_items_kept(t, **(assembly or {})))
    return {
        "purchased_items": lambda: tabs.purchase_inventory_tab(t, items(), units()),
        "purchased_locations": lambda: tabs.purchase_locations_tab(t, items()),
        "purchased_item_vendors": lambda: tabs.purchase_item_vendors_tab(t, items()),
        "assemblies": lambda: tabs.assembly_inventory_tab(t, items=kept(), units=units()),
        "assembly_locations": lambda: tabs.assembly_locations_tab(t, ordered=True, items=kept()),
        "assembly_item_vendors": lambda: tabs.assembly_item_vendors_tab(t, items=kept()),
    }


def _bom(t: Mapping[str, DataFrame], stage: StageOf) -> Builders:
    selected = _once(stage, "selected_boms", lambda: tabs.selected_boms(t))
    bom_main = _once(stage, "bill_of_materials", lambda: tabs.bom_tab(selected()))
    return {
        "bills_of_materials": bom_main,
        "bom_revisions": lambda: tabs.bom_revision_tab(selected()),
        "bom_revision_components": lambda: tabs.bom_revision_components_tab(t, selected()),
        "assembly_bom_links": lambda: tabs.assembly_bom_link_tab(selected()),
        "routings": lambda: tabs.routing_header_tab(bom_main(), ordered=True),
        "routing_steps": lambda: tabs.routing_steps_tab(t, bom_main()),
    }


def tab_builders(t: Mapping[str, DataFrame], stage: StageOf = _write_now, address: dict | None = None, vendor: dict | None = None,
                 purchased: dict | None = None, assembly: dict | None = None) -> Builders:
    """A function for every tab, in the scripts' order; intermediates are staged when a tab first needs them."""
    return {**_customer(t, stage, **(address or {})), **_vendor(t, **(vendor or {})), **_item(t, stage, purchased, assembly), **_bom(t, stage)}


def _built(builders: Builders) -> dict[str, DataFrame]:
    return {name: build() for name, build in builders.items()}


def customer_tabs(t: Mapping[str, DataFrame], **address_options) -> dict[str, DataFrame]:
    """T1-T4; the universe is staged once and read by T1 and T4."""
    return _built(_customer(t, _write_now, **address_options))


def vendor_tabs(t: Mapping[str, DataFrame], **vendor_options) -> dict[str, DataFrame]:
    """T5."""
    return _built(_vendor(t, **vendor_options))


def item_tabs(t: Mapping[str, DataFrame], purchased: dict | None = None,
              assembly: dict | None = None) -> dict[str, DataFrame]:
    """T6-T11; item sets and latest units are staged once."""
    return _built(_item(t, _write_now, purchased, assembly))


def bom_tabs(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """T12-T17; the selected BOMs and the BOM main table are staged once."""
    return _built(_bom(t, _write_now))


def write_tab(name: str, df: DataFrame, out_dir: str, fmt: str = "csv", legacy_names: bool = False,
              values: Mapping[str, str] | None = None) -> str:
    """Write one tab to its folder below ``out_dir``, in its export order; returns the path."""
    df = tabs.with_template_values(df, values or {})
    if TAB_ORDER.get(name):
        df = tabs.sorted_for_export(df, TAB_ORDER[name])
    if legacy_names:
        df = tabs.with_legacy_names(df)
    path = f"{out_dir.rstrip('/')}/{name}"
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def write_tabs(built: Mapping[str, DataFrame], out_dir: str, fmt: str = "csv", legacy_names: bool = False,
               values: Mapping[str, str] | None = None) -> dict[str, str]:
    """Write tabs below ``out_dir``, one folder each. Returns tab name -> path."""
    return {name: write_tab(name, df, out_dir, fmt, legacy_names, values) for name, df in built.items()}


class ExportRun:
    """The committed tabs and stages of one export, kept beside its output.

    A tab or stage is committed by an empty mark, created when its files are
    complete, in ``<output>/_export/<key>``. The key stands for the input files
    and the options, so that a rerun of the same export goes on after the last
    mark, and any other one starts afresh. Stages lie below the shared folder
    under the same key; an export owns its own and nobody else's. Marks and
    stages go when the export is complete.
    """

    def __init__(self, spark: SparkSession, out_dir: str, tables: Mapping[str, DataFrame], options: Mapping):
        inputs = {name: sorted(df.inputFiles()) or df.schema.json() for name, df in sorted(tables.items())}
        told = json.dumps([out_dir, inputs, options], default=str, sort_keys=True)
        self.key = hashlib.sha256(told.encode()).hexdigest()[:16]
        self.spark = spark
        self.marks = f"{out_dir.rstrip('/')}/_export/{self.key}"
        self.stages = f"{shared_dir(spark)}/stages/export-{self.key}"
        self.reused: list[str] = []

    def committed(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.marks}/{name}")

    def commit(self, name: str) -> None:
        create_mark(self.spark, f"{self.marks}/{name}")

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """An intermediate of several tabs: read back if it is committed, else built, written and committed."""
        path, mark = f"{self.stages}/{name}", f"stage-{name}"
        if self.committed(mark) and path_exists(self.spark, path):
            self.reused.append(mark)
        else:
            build().write.mode("overwrite").parquet(path)
            self.commit(mark)
        return read_stage(self.spark, path)

    def tab(self, name: str, build: Callable[[], DataFrame], write: Callable[[DataFrame], str], path: str) -> str:
        """A tab, written unless it is committed; what its operators staged on the way goes with it."""
        if self.committed(f"tab-{name}") and path_exists(self.spark, path):
            self.reused.append(f"tab-{name}")
            return path
        with collected_stages() as paths:
            try:
                write(build())
            finally:
                for stage in paths:
                    remove_stage(self.spark, stage)
        self.commit(f"tab-{name}")
        return path

    def finish(self) -> None:
        for path in (self.stages, self.marks):
            remove_stage(self.spark, path)


def export_all(t: Mapping[str, DataFrame], out_dir: str, fmt: str = "csv", legacy_names: bool = False,
               values: Mapping[str, str] | None = None, fresh: bool = False, **options) -> dict[str, str]:
    """Build and write every tab. An export that failed goes on where it stopped when it is run again with the
    same inputs, output and options; ``fresh`` starts over."""
    spark = next(iter(t.values())).sparkSession
    run = ExportRun(spark, out_dir, t, {"fmt": fmt, "legacy_names": legacy_names, "values": values, **options})
    if fresh:
        run.finish()
    paths = {name: run.tab(name, build, lambda df, name=name: write_tab(name, df, out_dir, fmt, legacy_names, values),
                           f"{out_dir.rstrip('/')}/{name}")
             for name, build in tab_builders(t, run.stage, **options).items()}
    run.finish()
    return paths


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The ERP tables below ``folder``, one parquet table ``<folder>/<name>`` each."""
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in tabs.TABLES}


def arguments(argv: list[str]) -> argparse.Namespace:
    date = dt.date.fromisoformat
    p = argparse.ArgumentParser(prog="tabsmith.plans.export", description="Write every import tab.")
    p.add_argument("tables", help="folder with one parquet table per ERP table")
    p.add_argument("output", help="folder for the tabs")
    p.add_argument("--format", choices=("csv", "parquet"), default="csv")
    p.add_argument("--legacy-names", action="store_true", help="the target template's own column spellings")
    p.add_argument("--true-usage-totals", action="store_true", help="keep equal usage rows of two sources apart")
    p.add_argument("--fix-ship-to-defaults", action="store_true", help="ship-to addresses default for shipping")
    p.add_argument("--vendors-with-po", action="store_true", help="only vendors that have a purchase order")
    p.add_argument("--created-before", type=date, help="purchased items: cut-off of the creation date")
    p.add_argument("--last-moved-before", type=date, help="purchased items: cut-off of the last transaction")
    p.add_argument("--max-transactions", type=int)
    p.add_argument("--exclude-item", type=int, action="append", help="purchased item id to leave out; may repeat")
    p.add_argument("--stale-before", type=date, help="assemblies: cut-off of creation and last use")
    p.add_argument("--fresh", action="store_true", help="start over, also where an earlier run of this export was stopped")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE",
                   help=f"template value; names: {', '.join(tabs.TEMPLATE_COLUMNS)}")
    return p.parse_args(argv)


def options_of(args: argparse.Namespace) -> dict:
    """Keyword arguments of :func:`export_all` from the command line."""
    given = lambda **kw: {k: v for k, v in kw.items() if v is not None}
    return {
        "fresh": args.fresh, "fmt": args.format, "legacy_names": args.legacy_names, "values": dict(v.split("=", 1) for v in args.set),
        "address": {"union_all_sources": args.true_usage_totals, "fix_ship_to_defaults": args.fix_ship_to_defaults},
        "vendor": {"with_po_only": args.vendors_with_po},
        "purchased": given(created_before=args.created_before, last_moved_before=args.last_moved_before,
                           max_transactions=args.max_transactions,
                           excluded_ids=tuple(args.exclude_item) if args.exclude_item else None),
        "assembly": given(stale_before=args.stale_before),
    }


def main(argv: list[str]) -> None:
    from tabsmith.session import build_session

    args = arguments(argv)
    spark = build_session(master=None)
    export_all(read_tables(spark, args.tables), args.output, **options_of(args))


if __name__ == "__main__":
    main(sys.argv[1:])
