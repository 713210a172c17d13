"""Inverse of the normal distribution as a column expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published rational approximation AS 241 (Wichura 1988, routine PPND16),
# coefficients from the highest power down, (numerator, denominator) per region.
CENTRE = (
    [2.50908_09287_30122_6727e3, 3.34305_75583_58812_8105e4, 6.72657_70927_00870_0853e4,
     4.59219_53931_54987_1457e4, 1.37316_93765_50946_1125e4, 1.97159_09503_06551_4427e3,
     1.33141_66789_17843_7745e2, 3.38713_28727_96366_6080e0],
    [5.22649_52788_52854_5610e3, 2.87290_85735_72194_2674e4, 3.93078_95800_09271_0610e4,
     2.12137_94301_58659_5867e4, 5.39419_60214_24751_1077e3, 6.87187_00749_20579_0830e2,
     4.23133_30701_60091_1252e1, 1.0],
)
SHOULDER = (
    [7.74545_01427_83414_07640e-4, 2.27238_44989_26918_45833e-2, 2.41780_72517_74506_11770e-1,
     1.27045_82524_52368_38258e0, 3.64784_83247_63204_60504e0, 5.76949_72214_60691_40550e0,
     4.63033_78461_56545_29590e0, 1.42343_71107_49683_57734e0],
    [1.05075_00716_44416_84324e-9, 5.47593_80849_95344_94600e-4, 1.51986_66563_61645_71966e-2,
     1.48103_97642_74800_74590e-1, 6.89767_33498_51000_04550e-1, 1.67638_48301_83803_84940e0,
     2.05319_16266_37758_82187e0, 1.0],
)
TAIL = (
    [2.01033_43992_92288_13265e-7, 2.71155_55687_43487_57815e-5, 1.24266_09473_88078_43860e-3,
     2.65321_89526_57612_30930e-2, 2.96560_57182_85048_91230e-1, 1.78482_65399_17291_33580e0,
     5.46378_49111_64114_36990e0, 6.65790_46435_01103_77720e0],
    [2.04426_31033_89939_78564e-15, 1.42151_17583_16445_88870e-7, 1.84631_83175_10054_68180e-5,
     7.86869_13114_56132_59100e-4, 1.48753_61290_85061_48525e-2, 1.36929_88092_27358_05310e-1,
     5.99832_20655_58879_37690e-1, 1.0],
)


def _quotient(x: Column, coefficients: tuple[list[float], list[float]]) -> Column:
    top, bottom = (reduce(lambda acc, c: acc * x + F.lit(c), rest, F.lit(first)) for first, *rest in coefficients)
    return top / bottom


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile of a probability strictly between 0 and 1."""
    q = p - 0.5
    centre = q * _quotient(F.lit(0.180625) - q * q, CENTRE)
    distance = F.sqrt(-F.ln(F.least(p, 1.0 - p)))
    outer = F.when(distance <= 5.0, _quotient(distance - 1.6, SHOULDER)).otherwise(_quotient(distance - 5.0, TAIL))
    return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * outer)
