"""Vocabularies of the municipal sources."""

# Results depend on these words and pairs as they stand.
DIRECTIONS = {
    "N": "NORTH", "S": "SOUTH", "E": "EAST", "W": "WEST", "NE": "NORTHEAST", "NW": "NORTHWEST", "SE": "SOUTHEAST", "SW": "SOUTHWEST", "NO": "NORTH", "SO": "SOUTH",
}
#: Spellings of each street suffix, besides itself.
STREET_SUFFIXES = {
    "STREET": ["ST", "STR", "STREETS"],
    "AVENUE": ["AVE", "AV"],
    "BOULEVARD": ["BLVD", "BLV"],
    "ROAD": ["RD"],
    "PLACE": ["PL"],
    "DRIVE": ["DR"],
    "COURT": ["CT"],
    "LANE": ["LN"],
    "PARKWAY": ["PKWY", "PKY"],
    "TERRACE": ["TER", "TERR"],
    "HIGHWAY": ["HWY"],
    "EXPRESSWAY": ["EXPY", "EXPWY"],
    "SQUARE": ["SQ"],
    "CIRCLE": ["CIR"],
    "CRESCENT": ["CRES"],
    "WAY": [],
    "PLAZA": ["PLZ"],
    "BEACH": ["BCH"],
    "CONCOURSE": ["CONC"],
    "WALK": [],
    "ALLEY": ["ALY"],
    "BRIDGE": ["BRG"],
    "LOOP": [],
    "OVAL": [],
    "ROW": [],
    "SLIP": [],
    "TURNPIKE": ["TPKE"],
}
#: Code and spellings of each borough, besides its name.
BOROUGHS = {
    "MANHATTAN": ["1", "MN", "NEW YORK"],
    "BRONX": ["2", "THE BRONX", "BX"],
    "BROOKLYN": ["3", "BK", "KINGS"],
    "QUEENS": ["4", "QN", "QNS"],
    "STATEN ISLAND": ["5", "SI", "STATEN IS", "RICHMOND"],
}
UNIT_LABELS = ["APT", "APARTMENT", "UNIT", "STE", "SUITE", "RM", "ROOM", "FL", "FLOOR", "#", "PH"]
NULL_NAMES = [
    "", "N/A", "NA", "NONE", "UNKNOWN", "NOT APPLICABLE", "SAME", "OWNER", "TBD", "XX", "X", "-", "--", ".", "NULL", "NO NAME", "NOT AVAILABLE",
    "UNAVAILABLE OWNER", "UNAVAILABLE", "NAME UNAVAILABLE", "OWNER UNAVAILABLE",
]
#: Spellings of each word of organisation names, besides itself.
NAME_WORDS = {
    "LLC": ["LC", "PLLC"],
    "INC": ["INCORPORATED"],
    "CORP": ["CORPORATION"],
    "CO": ["COMPANY"],
    "LTD": ["LIMITED"],
    "ASSOCIATES": ["ASSOC", "ASSOCS"],
    "MANAGEMENT": ["MGMT", "MGT"],
    "REALTY": ["RLTY"],
    "PROPERTIES": ["PROP", "PROPS", "PROPERTY"],
    "DEVELOPMENT": ["DEV"],
    "BUILDING": ["BLDG"],
    "BUILDINGS": ["BLDGS"],
    "APARTMENTS": ["APTS"],
    "GROUP": ["GRP"],
    "HIGHWAY": ["HWY"],
    "PARKWAY": ["PKWY"],
    "BOULEVARD": ["BLVD"],
    "AVENUE": ["AVE"],
    "NEW YORK CITY": ["NYC"],
}
ORG_MARKERS = [
    "LLC", "INC", "CORP", "CO", "LTD", "LP", "LLP", "HDFC", "TRUST", "ASSOCIATES", "MANAGEMENT", "REALTY", "PROPERTIES", "DEVELOPMENT", "GROUP", "PARTNERS",
    "HOLDINGS", "EQUITIES", "VENTURES", "ENTERPRISES", "CHURCH", "CITY", "AUTHORITY", "HOUSING", "CENTER", "HOSPITAL", "UNIVERSITY", "SCHOOL", "BANK", "FUND",
    "ESTATES", "ESTATE", "APARTMENTS", "CONDOMINIUM", "CONDO", "COOPERATIVE", "COOP", "OWNERS", "TENANTS",
]
LEGAL_TOKENS = ["LLC", "INC", "CORP", "CO", "LTD", "LP", "LLP", "THE"]
EMERGENCY_TYPES = ["HEAT/HOT WATER", "NO WATER", "ELECTRIC", "GAS", "PLUMBING", "WATER LEAK", "ELEVATOR", "STRUCTURAL"]
OWNER_CONTACTS = ["CorporateOwner", "IndividualOwner", "HeadOfficer", "Officer", "JointOwner", "SiteManager"]
MAILING_CONTACTS = ["CorporateOwner", "IndividualOwner", "JointOwner"]
