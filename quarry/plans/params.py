"""Query parameters bound to the supplied tables, in one place.

Fixed values: stand-ins for the literals of the business questions
(types, locations, year, area, thresholds), chosen at sf 0.01 and passed to
both the Spark query and its oracle SQL.
"""

TYPE_A = "STANDARD"          # first type of the ratio question
TYPE_B = "ECONOMY"           # second type of the ratio question
THEFT_TYPE = "PROMO"         # "top districts for one type"
DAMAGE_TYPE = "LARGE"        # "top locations for one type"
STREET_EVENT = "click"        # "at one location type, late at night": needs a time of day
STREET_LOCATION = "Brand#4"  # "crimes at one location type"
SHARE_YEAR = 1998            # arrest share within one year
AREA = 40                    # one community area
DISTRICT_MIN_TOTAL = 1000    # districts with more incidents than this
CODE_MIN_TOTAL = 600         # codes with more incidents than this
NIGHT_HOURS = (0, 6)         # [start, end) hour band
DAY_HOURS = (12, 18)
LATE_NIGHT_HOURS = (22, 6)   # wraps midnight: hour >= 22 or hour < 6

# declared questions
BQ_TYPE = "PROMO"
BQ_DESCRIPTION = "red widget"
BQ_LOCATION = "Brand#7"
BQ_YEAR = 1997
BQ_WARD = 12
BQ_NARCOTICS_TYPE = "STANDARD"
SEVERITY_LEAVE_OUT = "SMALL"

MIN_YEAR = 1996              # dates before this year are suspicious

# anomaly box of the binding (latitude = l_extendedprice, longitude = l_quantity)
ANOMALY_RULES = {
    "latitude": (1000.0, 104000.0),
    "longitude": (2.0, 49.0),
    "district": (1, 24),
    "ward": (1, 24),
    "community_area": (1, 77),
}
