"""Parameters derived with calibration coefficients.

`calibration`: one row per (glider_id, parameter) with `coef` as map<string,double>. A missing
coefficient gives a missing result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.seawater import literal, practical_salinity, series, with_seawater
from .align import ctd_at_samples
from .ordered import stats_join

# --- fixed values: salinity and pressure compensation of molar oxygen --------------------------
VAPOUR = (24.4543, -67.4509, -4.8489, -5.44e-4)
MOLAR_B = [-6.24523e-3, -7.37614e-3, -1.03410e-2, -8.17083e-3]
MOLAR_C0, MOLAR_PRESET, MOLAR_P2, MOLAR_P3 = -4.88682e-7, 0.0, 0.00025, 0.0328
# --- fixed values: oxygen solubility for the frequency sensor ----------------------------------
SOLUBILITY_A = [2.00907, 3.22014, 4.0501, 4.94457, -0.256847, 3.88767]
SOLUBILITY_B = [-0.00624523, -0.00737614, -0.00103410, -0.00817083]
SOLUBILITY_C0, MICROMOLES_PER_ML = -0.000000488682, 44.6596
# --- fixed values: scattering by seawater --------------------------------------------------------
AVOGADRO, BOLTZMANN, WATER_MOLE, DEPOLARISATION = 6.0221417930e23, 1.3806503e-23, 18e-3, 0.039
WATER_DENSITY = [999.842594, 6.793952e-2, -9.09529e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9]
SALT_DENSITY_1 = [8.24493e-1, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9]
SALT_DENSITY_15, SALT_DENSITY_2 = [-5.72466e-3, 1.0227e-4, -1.6546e-6], 4.8314e-4
BULK_WATER = [19652.21, 148.4206, -2.327105, 1.360477e-2, -5.155288e-5]
BULK_1, BULK_15 = [54.6746, -0.603459, 1.09987e-2, -6.167e-5], [7.944e-2, 1.6483e-2, -5.3009e-4]
ACTIVITY_1 = [-5.58651e-4, 2.40452e-7, -3.12165e-9, 2.40808e-11]
ACTIVITY_05, ACTIVITY_2 = [1.79613e-5, -9.9422e-8, 2.08919e-9, -1.39872e-11], [-2.31065e-6, -1.37674e-9, -1.93316e-11]
INDEX = (1.31405, 1.779e-4, -1.05e-6, 1.6e-8, -2.02e-6, 15.868, 0.01155, -0.00423, -4382.0, 1.1455e6)


def with_coefficients(df: DataFrame, calibration: DataFrame, parameter: str, names: list[str]) -> DataFrame:
    """Coefficients of one parameter as columns `c_<name>`."""
    mine = calibration.filter(F.col("parameter") == parameter).select("glider_id", *[F.col("coef")[n].alias(f"c_{n}") for n in names])
    return stats_join(df, mine, ["glider_id"])


def rescale(df: DataFrame, calibration: DataFrame, variable: str, out: str) -> DataFrame:
    joined = with_coefficients(df, calibration, variable, ["slope", "offset"])
    return joined.withColumn(out, F.col(variable) * F.col("c_slope") + F.col("c_offset")).drop("c_slope", "c_offset")


def fill_salinity(df: DataFrame) -> DataFrame:
    """Salinity from conductivity (S/m) where it is absent; results off the scale stay missing."""
    computed = F.expr(practical_salinity("(conductivity*10e0)", "temperature", "pressure"))
    return df.withColumn("salinity", F.coalesce("salinity", F.when(~F.isnan(computed), computed)))


def counts_to_units(df: DataFrame, calibration: DataFrame, variable: str, out: str) -> DataFrame:
    """(count - dark) * scale for chlorophyll, CDOM and turbidity."""
    joined = with_coefficients(df, calibration, variable, ["dark", "scale"])
    return joined.withColumn(out, (F.col(variable) - F.col("c_dark")) * F.col("c_scale")).drop("c_dark", "c_scale")


def seawater_scattering(t: str, s: str, wavelength: float, angle: str) -> list[tuple[str, str]]:
    """Stages ending in `beta_sw`, the scattering of seawater at one wavelength and angle."""
    lam, root = literal(wavelength), f"sqrt({s})"
    n0, n1, n2, n3, n4, n5, n6, n7, n8, n9 = (literal(v) for v in INDEX)
    um2 = 1.0 / (wavelength / 1e3) ** 2
    air = literal(1.0 + (5792105.0 / (238.0185 - um2) + 167917.0 / (57.362 - um2)) / 1e8)
    d = DEPOLARISATION
    front = math.pi**2 * (wavelength * 1e-9) ** -4 * (6 + 6 * d) / (6 - 7 * d)
    cosine = f"cos(radians({angle}))"
    return [
        ("b_n", f"{air}*({n0} + ({n1} + {n2}*{t} + {n3}*{t}*{t})*{s} + {n4}*{t}*{t} + ({n5} + {n6}*{s} + {n7}*{t})/{lam} + {n8}/({lam}*{lam}) + {n9}/({lam}*{lam}*{lam}))"),
        ("b_dn", f"{air}*({n1} + {n2}*{t} + {n3}*{t}*{t} + {n6}/{lam})"),
        ("b_iso", f"1e-5/({series(BULK_WATER, t)} + {series(BULK_1, t)}*{s} + {series(BULK_15, t)}*{s}*{root})"),
        ("b_rho", f"{series(WATER_DENSITY, t)} + {series(SALT_DENSITY_1, t)}*{s} + {series(SALT_DENSITY_15, t)}*{s}*{root} + {literal(SALT_DENSITY_2)}*{s}*{s}"),
        ("b_act", f"{series(ACTIVITY_1, t)} + 1.5e0*{series(ACTIVITY_05, t)}*{root} + 2e0*{series(ACTIVITY_2, t)}*{s}"),
        ("b_pol", "(b_n*b_n - 1e0)*(1e0 + 2e0/3e0*(b_n*b_n + 2e0)*(b_n/3e0 - 1e0/(3e0*b_n))*(b_n/3e0 - 1e0/(3e0*b_n)))"),
        ("b_df", f"{literal(front / 2 * BOLTZMANN)}*({t} + 273.15e0)*b_iso*b_pol*b_pol"),
        ("b_cf", f"{literal(2 * front / AVOGADRO * WATER_MOLE)}*b_n*b_n*{s}*b_dn*b_dn/b_rho/(-b_act)"),
        ("beta_sw", f"(b_df + b_cf)*(1e0 + {cosine}*{cosine}*{literal((1 - d) / (1 + d))})"),
    ]


def backscatter(df: DataFrame, calibration: DataFrame, variable: str, wavelength: float, out: str) -> DataFrame:
    """Particle backscattering: 2 pi chi ((beta - dark) scale - beta_sw), scaling left out where
    the calibration has none. Temperature and salinity are interpolated at the sample times.

    Returns (glider_id, t_s, <variable>, <out>).
    """
    joined = with_coefficients(ctd_at_samples(df, variable), calibration, variable, ["dark", "scale", "chi", "angle"])
    stages = seawater_scattering("temperature_at", "salinity_at", wavelength, "c_angle")
    for name, text in stages:
        joined = joined.withColumn(name, F.expr(text))
    raw = F.coalesce((F.col(variable) - F.col("c_dark")) * F.col("c_scale"), F.col(variable))
    value = 2 * math.pi * F.col("c_chi") * (raw - F.col("beta_sw"))
    return joined.select("glider_id", "t_s", variable, value.alias(out))


def _located(df: DataFrame) -> Column:
    return (F.abs("latitude") <= 90) & (F.abs("longitude") <= 180)


def _per_kilogram(df: DataFrame, amount: Column, out: str) -> DataFrame:
    """Amount per litre over the potential density at the surface; needs a valid position."""
    names = df.columns
    dense = with_seawater(df)
    return dense.withColumn(out, F.when(_located(df), amount / ((F.col("sigma0") + 1000.0) / 1000.0))).select(*names, out)


def _scaled_temperature(t: str) -> str:
    return f"ln((298.15e0 - {t})/(273.15e0 + {t}))"


def oxygen_solubility(scaled: str, salinity_terms: list[float]) -> str:
    """Millilitres per litre at saturation, from scaled temperature and `salinity`."""
    return f"exp({series(SOLUBILITY_A, scaled)} + salinity*{series(salinity_terms, scaled)} + {literal(SOLUBILITY_C0)}*salinity*salinity)"


def oxygen_from_frequency(
    df: DataFrame, calibration: DataFrame, variable: str, out: str, salinity_terms: list[float] = SOLUBILITY_B
) -> DataFrame:
    """Amount per kilogram from a frequency; `salinity_terms=MOLAR_B` for the published solubility (see README)."""
    names = ["soc", "offset", "a", "b", "c", "e"]
    joined = with_coefficients(df, calibration, variable, names).withColumn("__ts", F.expr(_scaled_temperature("temperature")))
    solubility = oxygen_solubility("__ts", salinity_terms)
    amount = (
        f"{literal(MICROMOLES_PER_ML)}*c_soc*({variable} + c_offset)*{solubility}*(1e0 + temperature*(c_a + temperature*(c_b + temperature*c_c)))"
        "*exp(c_e*pressure/(273.15e0 + temperature))"
    )
    return _per_kilogram(joined, F.expr(amount), out).drop("__ts", *[f"c_{n}" for n in names])


def oxygen_from_molar(df: DataFrame, calibration: DataFrame, variable: str, out: str) -> DataFrame:
    """Salinity and pressure compensation; the reference salinity is 0 where none is given."""
    joined = with_coefficients(df, calibration, variable, ["reference_salinity"]).withColumns(
        {"__ts": F.expr(_scaled_temperature("temperature")), "__ref": F.coalesce("c_reference_salinity", F.lit(0.0)), "__k": F.expr("temperature + 273.15e0")}
    )
    d0, d1, d2, d3 = (literal(v) for v in VAPOUR)
    vapour = lambda s: f"1013.25e0*exp({d0} + {d1}*(100e0/__k) + {d2}*ln(__k/100e0) + {d3}*{s})"
    amount = (
        f"{variable}*((1013.25e0 - {vapour(literal(MOLAR_PRESET))})/(1013.25e0 - {vapour('salinity')}))"
        f"*exp((salinity - __ref)*{series(MOLAR_B, '__ts')} + {literal(MOLAR_C0)}*(salinity*salinity - __ref*__ref))"
        f"*(1e0 + ({literal(MOLAR_P2)}*temperature + {literal(MOLAR_P3)})*pressure/1000e0)"
    )
    return _per_kilogram(joined, F.expr(amount), out).drop("__ts", "__ref", "__k", "c_reference_salinity")


def nitrate_per_kilogram(df: DataFrame, variable: str, out: str) -> DataFrame:
    return _per_kilogram(df, F.col(variable), out)
