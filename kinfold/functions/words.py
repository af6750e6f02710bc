"""Word tables of the text rules."""

# Spelling variants of words in business names.
NAME_WORDS = {
    "pvt": "private", "pvte": "private", "prv": "private", "priv": "private",
    "ltd": "limited", "ltda": "limited", "lmtd": "limited", "limted": "limited",
    "co": "company", "cos": "companies", "comp": "company",
    "corp": "corporation", "corpn": "corporation", "corpo": "corporation",
    "inc": "incorporated", "incorp": "incorporated", "incorporation": "incorporated",
    "l.l.c": "llc", "l.l.p": "llp", "pte": "private", "pty": "proprietary",
    "sarl": "sarl", "sas": "sas", "sasu": "sasu", "eurl": "eurl",
    "intl": "international", "int'l": "international", "natl": "national",
    "mfg": "manufacturing", "mfrs": "manufacturers", "mgmt": "management",
    "svcs": "services", "svc": "services", "srvs": "services", "assoc": "associates",
    "assocs": "associates", "bros": "brothers", "ent": "enterprises",
    "entp": "enterprises", "ents": "enterprises", "indus": "industries", "inds": "industries",
    "dept": "department", "univ": "university", "hosp": "hospital", "govt": "government",
    "tech": "technologies", "techs": "technologies", "technology": "technologies",
    "sys": "systems", "solns": "solutions", "soln": "solutions", "grp": "group",
    "hldgs": "holdings", "hldg": "holdings", "invest": "investments", "mktg": "marketing",
    "dist": "distributors", "distr": "distributors", "pharma": "pharmaceuticals",
    "chem": "chemicals", "engg": "engineering", "engr": "engineering",
    "constr": "construction", "consult": "consultants",
    "&": "and", "et": "and", "und": "and",
}

# Words that a name's core leaves out.
LEGAL_WORDS = (
    "private", "limited", "company", "companies", "corporation", "incorporated", "llc", "llp",
    "plc", "lp", "proprietary", "gmbh", "ag", "kg", "bv", "nv", "srl", "spa", "sa", "sas",
    "sasu", "sarl", "eurl", "sci", "snc", "opc", "the", "and", "of", "le", "la", "les", "de",
    "des", "du", "m/s", "ms", "messrs",
)

# Spelling variants of words in addresses.
ADDRESS_WORDS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue",
    "blvd": "boulevard", "bd": "boulevard", "bvd": "boulevard", "ln": "lane", "dr": "drive",
    "hwy": "highway", "pkwy": "parkway", "sq": "square", "ct": "court", "pl": "place",
    "apt": "apartment", "appt": "apartment", "ste": "suite", "fl": "floor", "flr": "floor",
    "bldg": "building", "blg": "building", "no": "number", "nr": "near", "opp": "opposite",
    "sec": "sector", "sect": "sector", "ngr": "nagar", "mkt": "market", "mg": "mg",
    "dist": "district", "distt": "district", "tq": "taluk", "tal": "taluk", "po": "post",
    "ps": "police station", "ind": "industrial", "indl": "industrial", "est": "estate",
    "e": "east", "w": "west", "n": "north", "s": "south", "ne": "northeast",
    "nw": "northwest", "se": "southeast", "sw": "southwest", "mt": "mount",
    "ft": "fort", "jn": "junction", "jct": "junction", "chk": "chowk",
    "cedex": "cedex", "fbg": "faubourg", "rte": "route", "imp": "impasse", "pl.": "place",
    "&": "and",
}

# Names of countries; others pass through.
COUNTRY_NAMES = {
    "us": "us", "usa": "us", "u s": "us", "u s a": "us", "united states": "us",
    "united states of america": "us", "america": "us", "etats unis": "us",
    "in": "in", "ind": "in", "india": "in", "bharat": "in", "republic of india": "in",
    "fr": "fr", "fra": "fr", "france": "fr", "republique francaise": "fr", "french republic": "fr",
    "uk": "gb", "gb": "gb", "gbr": "gb", "united kingdom": "gb", "great britain": "gb", "england": "gb",
    "de": "de", "deu": "de", "germany": "de", "deutschland": "de",
    "ca": "ca", "can": "ca", "canada": "ca", "es": "es", "spain": "es", "espana": "es",
    "it": "it", "italy": "it", "italia": "it", "jp": "jp", "japan": "jp",
    "cn": "cn", "china": "cn", "br": "br", "brazil": "br", "brasil": "br",
    "mx": "mx", "mexico": "mx", "au": "au", "australia": "au",
}
