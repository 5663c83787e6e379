"""Seawater state as SQL expressions: practical salinity (PSS-78) and the 2010 equation of state.

Absolute salinity is taken as S * 35.16504 / 35: the regional anomaly atlas is a data file
that is not public-domain text, so its anomaly is treated as 0 (an error below 0.03 g/kg in the
open ocean, and a near-constant offset in density).

Expressions are text so that a table operator can stage them in projections and Catalyst keeps
them inside generated code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Terms = dict[tuple[int, int, int], float]

# --- fixed values: specific volume, powers of (salinity root, temperature, pressure) -------
SPECIFIC_VOLUME: Terms = {
    (0, 0, 0): 1.0769995862e-3, (0, 0, 1): -6.0799143809e-5, (0, 0, 2): 9.9856169219e-6,
    (0, 0, 3): -1.1309361437e-6, (0, 0, 4): 1.0531153080e-7, (0, 0, 5): -1.2647261286e-8,
    (0, 0, 6): 1.9613503930e-9, (0, 1, 0): -1.5649734675e-5, (0, 1, 1): 1.8505765429e-5,
    (0, 1, 2): -1.1736386731e-6, (0, 1, 3): -3.6527006553e-7, (0, 1, 4): 3.1454099902e-7,
    (0, 2, 0): 2.7762106484e-5, (0, 2, 1): -1.1716606853e-5, (0, 2, 2): 2.1305028740e-6,
    (0, 2, 3): 2.8695905159e-7, (0, 3, 0): -1.6521159259e-5, (0, 3, 1): 7.9279656173e-6,
    (0, 3, 2): -4.6132540037e-7, (0, 4, 0): 6.9111322702e-6, (0, 4, 1): -3.4102187482e-6,
    (0, 4, 2): -6.3352916514e-8, (0, 5, 0): -8.0539615540e-7, (0, 5, 1): 5.0736766814e-7,
    (0, 6, 0): 2.0543094268e-7, (1, 0, 0): -3.1038981976e-4, (1, 0, 1): 2.4262468747e-5,
    (1, 0, 2): -5.8484432984e-7, (1, 0, 3): 3.6310188515e-7, (1, 0, 4): -1.1147125423e-7,
    (1, 1, 0): 3.5009599764e-5, (1, 1, 1): -9.5677088156e-6, (1, 1, 2): -5.5699154557e-6,
    (1, 1, 3): -2.7295696237e-7, (1, 2, 0): -3.7435842344e-5, (1, 2, 1): -2.3678308361e-7,
    (1, 2, 2): 3.9137387080e-7, (1, 3, 0): 2.4141479483e-5, (1, 3, 1): -3.4558773655e-6,
    (1, 3, 2): 7.7618888092e-9, (1, 4, 0): -8.7595873154e-6, (1, 4, 1): 1.2956717783e-6,
    (1, 5, 0): -3.3052758900e-7, (2, 0, 0): 6.6928067038e-4, (2, 0, 1): -3.4792460974e-5,
    (2, 0, 2): -4.8122251597e-6, (2, 0, 3): 1.6746303780e-8, (2, 1, 0): -4.3592678561e-5,
    (2, 1, 1): 1.1100834765e-5, (2, 1, 2): 5.4620748834e-6, (2, 2, 0): 3.5907822760e-5,
    (2, 2, 1): 2.9283346295e-6, (2, 2, 2): -6.5731104067e-7, (2, 3, 0): -1.4353633048e-5,
    (2, 3, 1): 3.1655306078e-7, (2, 4, 0): 4.3703680598e-6, (3, 0, 0): -8.5047933937e-4,
    (3, 0, 1): 3.7470777305e-5, (3, 0, 2): 4.9263106998e-6, (3, 1, 0): 3.4532461828e-5,
    (3, 1, 1): -9.8447117844e-6, (3, 1, 2): -1.3544185627e-6, (3, 2, 0): -1.8698584187e-5,
    (3, 2, 1): -4.8826139200e-7, (3, 3, 0): 2.2863324556e-6, (4, 0, 0): 5.8086069943e-4,
    (4, 0, 1): -1.7322218612e-5, (4, 0, 2): -1.7811974727e-6, (4, 1, 0): -1.1959409788e-5,
    (4, 1, 1): 2.5909225260e-6, (4, 2, 0): 3.8595339244e-6, (5, 0, 0): -2.1092370507e-4,
    (5, 0, 1): 3.0927427253e-6, (5, 1, 0): 1.3864594581e-6, (6, 0, 0): 3.1932457305e-5,
}
# --- fixed values: temperature derivative of the Gibbs function (entropy, sign reversed) ----
ENTROPY: Terms = {
    (0, 0, 1): -270.983805184062, (0, 0, 2): 776.153611613101, (0, 0, 3): -196.51255088122,
    (0, 0, 4): 28.9796526294175, (0, 0, 5): -2.13290083518327, (0, 1, 0): -24715.571866078,
    (0, 1, 1): 2910.0729080936, (0, 1, 2): -1513.116771538718, (0, 1, 3): 546.959324647056,
    (0, 1, 4): -111.1208127634436, (0, 1, 5): 8.68841343834394, (0, 2, 0): 2210.2236124548363,
    (0, 2, 1): -2017.52334943521, (0, 2, 2): 1498.081172457456, (0, 2, 3): -718.6359919632359,
    (0, 2, 4): 146.4037555781616, (0, 2, 5): -4.9892131862671505, (0, 3, 0): -592.743745734632,
    (0, 3, 1): 1591.873781627888, (0, 3, 2): -1207.261522487504, (0, 3, 3): 608.785486935364,
    (0, 3, 4): -105.4993508931208, (0, 4, 0): 290.12956292128547, (0, 4, 1): -973.091553087975,
    (0, 4, 2): 602.603274510125, (0, 4, 3): -276.361526170076, (0, 4, 4): 32.40953340386105,
    (0, 5, 0): -113.90630790850321, (0, 5, 1): 381.06836198507096, (0, 5, 2): -133.7383902842754,
    (0, 5, 3): 49.023632509086724, (0, 6, 0): 21.35571525415769, (0, 6, 1): -67.41756835751434,
    (2, 0, 1): 729.116529735046, (2, 0, 2): -343.956902961561, (2, 0, 3): 124.687671116248,
    (2, 0, 4): -31.656964386073, (2, 0, 5): 7.04658803315449, (2, 1, 0): 1760.062705994408,
    (2, 1, 1): -1721.528607567954, (2, 1, 2): 674.819060538734, (2, 1, 3): -356.629112415276,
    (2, 1, 4): 88.4080716616, (2, 1, 5): -15.84003094423364, (2, 2, 0): -675.802947790203,
    (2, 2, 1): 2082.7344423998043, (2, 2, 2): -614.668925894709, (2, 2, 3): 340.685093521782,
    (2, 2, 4): -33.3848202979239, (2, 3, 0): 365.7041791005036, (2, 3, 1): -1190.914967948748,
    (2, 3, 2): 298.904564555024, (2, 3, 3): -145.9491676006352, (2, 4, 0): -108.30162043765552,
    (2, 5, 0): 12.78101825083098, (3, 0, 1): -175.292041186547, (3, 0, 2): 83.1923927801819,
    (3, 0, 3): -29.483064349429, (3, 1, 0): -86.1329351956084, (3, 1, 1): 766.116132004952,
    (3, 1, 2): -108.3834525034224, (3, 1, 3): 51.2796974779828, (3, 2, 0): -30.0682112585625,
    (3, 2, 1): -1380.9597954037708, (3, 3, 0): 3.50240264723578, (3, 3, 1): 938.26075044542,
    (4, 0, 1): -22.6683558512829, (4, 1, 0): -137.1145018408982, (4, 2, 0): 148.10030845687618,
    (4, 3, 0): -68.5590309679152, (4, 4, 0): 12.4848504784754,
}
# --- fixed values: potential enthalpy --------------------------------------------------------
ENTHALPY: Terms = {
    (0, 0, 0): 61.01362420681071, (0, 1, 0): 168776.46138048015, (0, 2, 0): -2735.2785605119625,
    (0, 3, 0): 2574.2164453821433, (0, 4, 0): -1536.6644434977543, (0, 5, 0): 545.7340497931629,
    (0, 6, 0): -50.91091728474331, (0, 7, 0): -18.30489878927802, (2, 0, 0): 268.5520265845071,
    (2, 1, 0): -12019.028203559312, (2, 2, 0): 3734.858026725145, (2, 3, 0): -2046.7671145057618,
    (2, 4, 0): 465.28655623826234, (2, 5, 0): -0.6370820302376359, (2, 6, 0): -10.650848542359153,
    (3, 0, 0): 937.2099110620707, (3, 1, 0): 588.1802812170108, (3, 2, 0): 248.39476522971285,
    (3, 3, 0): -3.871557904936333, (3, 4, 0): -2.6268019854268356, (4, 0, 0): -1687.914374187449,
    (4, 1, 0): 936.3206544460336, (4, 2, 0): -942.7827304544439, (4, 3, 0): 369.4389437509002,
    (4, 4, 0): -33.83664947895248, (4, 5, 0): -9.987880382780322, (5, 0, 0): 246.9598888781377,
    (6, 0, 0): 123.59576582457964, (7, 0, 0): -48.5891069025409,
}
# --- fixed values: dynamic enthalpy of standard seawater, powers of pressure -----------------
STANDARD_ENTHALPY: Terms = {
    (0, 0, 1): 9.726613854843870e-4, (0, 0, 2): -2.252956605630465e-5, (0, 0, 3): 2.376909655387404e-6,
    (0, 0, 4): -1.664294869986011e-7, (0, 0, 5): -5.988108894465758e-9, (0, 0, 6): -2.1078768810e-9,
    (0, 0, 7): 2.8019291329e-10,
}
# --- fixed values: practical salinity scale 1978, and constants of the state equation --------
PSS_A = [0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081]
PSS_B = [0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144]
PSS_C = [0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9]
PSS_D = [3.426e-2, 4.464e-4, 4.215e-1, -3.107e-3]
PSS_E = [2.070e-5, -6.370e-10, 3.989e-15]
PSS_K, PSS_C35 = 0.0162, 42.9140
SALT_UNIT = "0.0248826675584615e0"
SALT_SHIFT = "5.971840214030754e-1"
HEAT_CAPACITY = "3991.86795711963e0"
STANDARD_SALT = "35.16504e0"


def literal(c: float) -> str:
    return repr(float(c)) if "e" in repr(float(c)) else repr(float(c)) + "e0"


def series(coefs: list[float], x: str) -> str:
    """Nested polynomial in one variable."""
    text = literal(coefs[-1])
    for c in reversed(coefs[:-1]):
        text = f"({literal(c)} + {x}*{text})"
    return text


def polynomial(terms: Terms, x: str = "0", y: str = "0", z: str = "0") -> str:
    """Nested polynomial in z, then y, then x."""

    def nest(parts: dict[int, str], v: str) -> str:
        text = parts.get(max(parts), "0e0")
        for k in range(max(parts) - 1, -1, -1):
            text = f"({parts.get(k, '0e0')} + {v}*{text})"
        return text

    by_zy: dict[int, dict[int, dict[int, str]]] = {}
    for (i, j, k), c in terms.items():
        by_zy.setdefault(k, {}).setdefault(j, {})[i] = literal(c)
    return nest({k: nest({j: nest(xs, x) for j, xs in ys.items()}, y) for k, ys in by_zy.items()}, z)


def at_surface(terms: Terms) -> Terms:
    return {k: c for k, c in terms.items() if k[2] == 0}


def by_temperature(terms: Terms) -> Terms:
    return {(i, j - 1, k): c * j for (i, j, k), c in terms.items() if j > 0}


def absolute_salinity(sp: str) -> str:
    return f"(greatest({sp}, 0e0)*{STANDARD_SALT}/35e0)"


def practical_salinity(c: str, t: str, p: str) -> str:
    """From conductivity in mS/cm, temperature and pressure; NULL outside the scale."""
    t68 = f"({t}*1.00024e0)"
    d1, d2, d3, d4 = (literal(v) for v in PSS_D)
    rp = f"(1e0 + {p}*{series(PSS_E, p)}/(1e0 + {d1}*{t68} + {d2}*{t68}*{t68} + ({d3} + {d4}*{t68})*({c}/{literal(PSS_C35)})))"
    rt = f"(({c}/{literal(PSS_C35)})/({rp}*{series(PSS_C, t68)}))"
    root = f"sqrt(CASE WHEN {rt} >= 0e0 THEN {rt} END)"
    ft = f"(({t68} - 15e0)/(1e0 + {literal(PSS_K)}*({t68} - 15e0)))"
    return f"({series(PSS_A, root)} + {ft}*{series(PSS_B, root)})"


def depth_from_pressure(p: str, lat: str) -> str:
    s2 = f"(sin(radians({lat}))*sin(radians({lat})))"
    g = f"(9.780327e0*(1e0 + (5.2792e-3 + 2.32e-5*{s2})*{s2}))"
    h = f"(1e8*{polynomial(STANDARD_ENTHALPY, z=f'({p}*1e-4)')})"
    return f"(2e0*{h}/({g} + sqrt({g}*{g} - 2e0*2.26e-7*{g}*{h})))"


def density_of(sa: str, ct: str, p: str) -> str:
    return (
        "(1e0/"
        + polynomial(SPECIFIC_VOLUME, f"sqrt({SALT_UNIT}*{sa} + {SALT_SHIFT})", f"({ct}*0.025e0)", f"({p}*1e-4)")
        + ")"
    )


def heat_stages(t: str, p: str, sa: str, pre: str = "") -> list[tuple[str, str]]:
    """Named stages from in-situ temperature to conservative temperature `<pre>ct`.

    A polynomial guess of potential temperature is refined by two modified Newton steps on
    entropy. Each stage reads the ones before it.
    """
    x = f"{pre}x"
    s1 = f"({sa}*35e0/{STANDARD_SALT})"
    guess = (
        f"{t} + {p}*(8.65483913395442e-6 - {s1}*1.41636299744881e-6 - {p}*7.38286467135737e-9 + "
        f"{t}*(-8.38241357039698e-6 + {s1}*2.83933368585534e-8 + {t}*1.77803965218656e-8 + {p}*1.71155619208233e-10))"
    )
    surface = at_surface(ENTROPY)
    stages = [
        (x, f"sqrt({SALT_UNIT}*{sa})"),
        (f"{pre}pt0", guess),
        (f"{pre}ent", f"(-0.025e0)*{polynomial(ENTROPY, x, f'({t}*0.025e0)', f'({p}*1e-4)')}"),
        (f"{pre}slope0", f"{HEAT_CAPACITY}/((273.15e0 + {pre}pt0)*(1e0 - 0.05e0*(1e0 - {sa}/{STANDARD_SALT})))"),
    ]
    for k in (1, 2):
        old, slope, new = f"{pre}pt{k - 1}", f"{pre}slope{k - 1}", f"{pre}pt{k}"
        stages += [
            (f"{pre}gap{k}", f"(-0.025e0)*{polynomial(surface, x, f'({old}*0.025e0)')} - {pre}ent"),
            (f"{pre}half{k}", f"0.5e0*({old} - {pre}gap{k}/{slope} + {old})"),
            (f"{pre}slope{k}", f"(-0.000625e0)*{polynomial(by_temperature(surface), x, f'({pre}half{k}*0.025e0)')}"),
            (new, f"{old} - {pre}gap{k}/{pre}slope{k}"),
        ]
    stages.append((f"{pre}ct", f"{polynomial(ENTHALPY, x, f'({pre}pt2*0.025e0)')}/{HEAT_CAPACITY}"))
    return stages


def with_seawater(
    df: DataFrame, temperature: str = "temperature", salinity: str = "salinity", pressure: str = "pressure"
) -> DataFrame:
    """Add `absolute_salinity`, `potential_temperature` (conservative), `rho` and `sigma0`.

    NULL where an input is missing or the temperature is outside the range of the equation.
    """
    t, p, sa = "__t", "__p", "absolute_salinity"
    valid = (
        f"CASE WHEN ({pressure} < 100 AND ({temperature} > 80 OR {temperature} < -12)) OR "
        f"({pressure} >= 100 AND ({temperature} > 40 OR {temperature} < -12)) THEN NULL ELSE {temperature} END"
    )
    out = df.withColumns(
        {
            t: F.expr(valid),
            p: F.expr(f"CAST({pressure} AS double)"),
            sa: F.expr(f"CASE WHEN {salinity} IS NOT NULL THEN {absolute_salinity(salinity)} END"),
        }
    )
    stages = heat_stages(t, p, sa, "__")
    for name, text in stages:
        out = out.withColumn(name, F.expr(text))
    out = out.withColumns(
        {
            "potential_temperature": F.col("__ct"),
            "rho": F.expr(density_of(sa, "__ct", p)),
            "sigma0": F.expr(density_of(sa, "__ct", "0e0") + " - 1000e0"),
        }
    )
    return out.drop(t, p, *[n for n, _ in stages])


def derive_variables(df: DataFrame) -> DataFrame:
    """Depth, salinity, conservative temperature and densities from the raw CTD channels.

    Conductivity is in S/m; depth uses the glider's own latitude column `mean_lat`.
    """
    depth = "CASE WHEN mean_lat IS NULL THEN pressure*1.019716e0 ELSE " + depth_from_pressure("pressure", "mean_lat") + " END"
    out = df.withColumns(
        {
            "depth": F.expr(depth),
            "salinity": F.expr(practical_salinity("(conductivity*10e0)", "temperature", "pressure")),
        }
    )
    out = with_seawater(out).withColumns(
        {"density": F.col("rho"), "potential_density": F.col("sigma0") + 1000.0}
    )
    return out.drop("rho", "sigma0", "absolute_salinity")
