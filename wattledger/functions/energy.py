"""Energy split, tiered pricing and ratio expressions on decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattledger.schemas import ENERGY, RATE, SUBSIDY_RATE, UNITS

def surplus(a: Column, b: Column, dtype: str = ENERGY) -> Column:
    """How far ``a`` exceeds ``b``, never below zero."""
    return F.greatest(a - b, F.lit(0).cast(dtype)).cast(dtype)


def percent(part: Column, whole: Column, digits: str) -> Column:
    """part / whole as a percentage, zero where there is no whole."""
    ratio = (part * F.lit(100)) / whole
    return F.when(whole > 0, ratio.cast(digits)).otherwise(F.lit(0).cast(digits))


def billed_units(net: Column) -> Column:
    """Net import priced in three blocks, as multiplied units."""
    cap1, cap2 = F.col("block1_cap"), F.col("block2_cap")
    above1 = surplus(net, cap1)
    in_block1 = F.least(net, cap1).cast(ENERGY)
    in_block2 = F.least(above1, cap2).cast(ENERGY)
    in_block3 = surplus(above1, cap2)
    return (
        in_block1 + in_block2 * F.col("block2_mult") + in_block3 * F.col("block3_mult")
    ).cast(UNITS)


def energy_charge(units: Column) -> Column:
    return F.col("tariff_rate").cast(RATE) * units


def export_credit(exported: Column) -> Column:
    return F.col("export_rate").cast(RATE) * exported


def subsidy(charge: Column) -> Column:
    """The discount applies to the energy charge only."""
    return F.when(F.col("subsidy_flag"), charge * F.lit(SUBSIDY_RATE).cast("decimal(3,2)")).otherwise(
        F.lit(0)
    )
