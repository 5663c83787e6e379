"""Column names, limits and name maps shared by the operators."""

from __future__ import annotations

# Variables that carry a quality flag.
QC_VARIABLES = [
    "temperature", "salinity", "pressure", "oxygen_concentration", "chlorophyll",
    "cdom", "backscatter_700", "density", "latitude", "longitude",
]

# Columns that describe an observation rather than measure something.
CONTEXT = [
    "glider_id", "t_s", "seq", "source_file", "depth", "pressure", "latitude", "longitude",
    "profile_index", "profile_direction", "heading", "pitch", "roll",
    "waypoint_latitude", "waypoint_longitude", "distance_over_ground",
]

# Suffixes of derived columns, and the order in which an adjusted column is looked up.
FLAG_SUFFIX = "_QC"
ADJUSTED_SUFFIXES = ["_lag_corrected", "_corrected", "_processed", "_adjusted"]

# --- fixed values: flag vocabulary -----------------------------------------------------
GOOD, PROBABLY_GOOD, PROBABLY_BAD, BAD, MISSING = 1, 2, 3, 4, 9
VERDICTS = [1, 2, 3, 4]

# --- fixed values: range limits --------------------------------------------------------
GLOBAL_RANGE = {
    "temperature": (-2.5, 40.0),
    "salinity": (2.0, 41.0),
    "pressure": (-5.0, 2000.0),
    "oxygen_concentration": (-5.0, 500.0),
    "chlorophyll": (-0.5, 50.0),
    "cdom": (-5.0, 375.0),
    "backscatter_700": (-0.01, 0.1),
    "density": (1000.0, 1060.0),
}
PHYSICAL_GUARD = {
    "temperature": (-2.5, 35.0),
    "salinity": (2.0, 41.0),
    "oxygen_concentration": (-5.0, 600.0),
}
SPIKE_LIMITS = {  # variable: (above 500 dbar, from 500 dbar down or pressure missing)
    "temperature": (2.0, 1.0),
    "salinity": (0.3, 0.1),
    "pressure": (20.0, 20.0),
    "oxygen_concentration": (50.0, 50.0),
}
STUCK_VARIABLES = ["temperature", "salinity", "pressure", "oxygen_concentration", "density"]
CASCADE_VARIABLES = [
    "temperature", "salinity", "oxygen_concentration", "density", "chlorophyll", "cdom", "backscatter_700",
]
DRIFT_LIMITS = {"salinity": 1.5, "temperature": 4.0}
DISPLAY_RANGE = {  # any other variable is left alone
    "temperature": (-3.0, 40.0),
    "salinity": (0.0, 45.0),
    "oxygen_concentration": (-5.0, 700.0),
    "chlorophyll": (-1.0, 200.0),
    "cdom": (-1.0, 500.0),
    "backscatter_700": (-0.01, 1.0),
}
DISPLAY_NAMES = {  # further names of the same quantities
    "temperature": ("potential_temperature", "sci_water_temp"),
    "salinity": ("practical_salinity",),
    "oxygen_concentration": ("oxygen", "dissolved_oxygen", "sci_oxy4_oxygen"),
    "chlorophyll": ("chlorophyll_flntu", "sci_flbbcd_chlor_units"),
    "cdom": ("sci_flbbcd_cdom_units",),
}
PLAUSIBLE_MAX = {
    "chlorophyll": 50.0,
    "cdom": 200.0,
    "backscatter_700": 0.05,
    "oxygen_concentration": 500.0,
}
FACTORY_BOX = (40.0, 43.0, -72.0, -69.0)  # lat min, lat max, lon min, lon max
SCIENCE_RANGE = {  # sensor: (low, high, high is included)
    "temperature": (-2.0, 40.0, True),
    "conductivity": (0.005, 10.0, False),
    "pressure": (-0.2, 200.0, False),
}

# --- fixed values: standard names and families -----------------------------------------
STANDARD_NAMES = {
    "temperature": ("TEMP", "core"),
    "salinity": ("PSAL", "core"),
    "pressure": ("PRES", "core"),
    "conductivity": ("CNDC", "core"),
    "density": ("DENS", "core"),
    "oxygen_concentration": ("DOXY", "bgc"),
    "chlorophyll": ("CHLA", "bgc"),
    "cdom": ("CDOM", "bgc"),
    "backscatter_700": ("BBP700", "bgc"),
}
# variables of the bgc family; all others are core
BGC_VARIABLES = (
    "oxygen_concentration", "chlorophyll", "cdom", "backscatter_700", "backscatter_470", "backscatter_532", "nitrate", "ph", "par",
    "downwelling_par",
)
