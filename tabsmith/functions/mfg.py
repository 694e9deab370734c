"""Manufacturing ids and work centers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions import fixed


def bom_external_id(item_number: Column) -> Column:
    return F.concat(item_number, F.lit(fixed.BOM_SUFFIX))


def revision_external_id(item_number: Column) -> Column:
    return F.concat(item_number, F.lit(fixed.REVISION_SUFFIX))


def routing_external_id(bom_external: Column) -> Column:
    return F.concat(bom_external, F.lit(fixed.ROUTING_SUFFIX))


def work_center(center_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for types, center in reversed(fixed.WORK_CENTERS):
        out = F.when(center_type.isin(*types), F.lit(center)).otherwise(out)
    return out


def operation_sequence(opseq: Column) -> Column:
    return opseq * fixed.OPERATION_STEP
