"""Fixed values of contact unification: word lists and lookup tables that results depend on."""

from __future__ import annotations

# Roots of given names with their variants; a variant that stands twice belongs to its last root.
NICKNAMES = {
    "william": ["will", "bill", "billy", "liam"],
    "robert": ["rob", "bob", "bobby", "robby"],
    "richard": ["rich", "rick", "ricky", "dick"],
    "edward": ["ed", "eddie", "ted", "teddy", "ned"],
    "margaret": ["meg", "maggie", "peggy"],
    "elizabeth": ["liz", "beth", "lizzy", "eliza", "liza", "betsy"],
    "katherine": ["kathy", "kate", "katie", "cathy", "cait"],
    "alexander": ["alex", "sasha"],
    "james": ["jim", "jimmy", "jamie"],
    "john": ["jack", "johnny"],
    "jonathan": ["jon", "john"],
    "joseph": ["joe", "joey"],
    "matthew": ["matt"],
    "michael": ["mike", "mikey"],
    "jeffrey": ["jeff"],
    "andrew": ["andy", "drew"],
    "steven": ["steve", "stevie"],
    "christopher": ["chris", "kit"],
    "patrick": ["pat", "paddy"],
    "nicholas": ["nick", "nicky"],
    "catherine": ["cathy", "kate", "katie"],
    "francis": ["frank", "frankie"],
}
NICKNAME_ROOT = {name: root for root, variants in NICKNAMES.items() for name in (root, *variants)}

# Generational suffixes, credentials, name prefixes, family-name particles.
GENERATIONAL = ['jr', 'sr', 'ii', 'iii', 'iv', 'v', 'vi']
PROFESSIONAL = [
    'phd', 'pmp', 'csm', 'spc6', 'ccim', 'phr', 'shrm', 'shrmcp', 'cp', 'mba', 'cissp', 'crisc', 'cscp', 'cams', 'cpa', 'cfa', 'pe', 'cisa', 'cism',
    'cfe', 'cma', 'ceh', 'itil', 'sixsigma', 'leansixsigma', 'esq', 'jd', 'ms', 'rdn', 'ld', 'mpa', 'ise', 'md', 'mph',
]
PREFIXES = [
    'mr', 'mrs', 'ms', 'miss', 'mx', 'dr', 'prof', 'sir', 'madam', 'madame', 'lady', 'lord', 'rev', 'reverend', 'fr', 'father', 'pastor', 'rabbi',
    'imam', 'hon', 'judge',
]
PARTICLES = [
    'da', 'de', 'del', 'della', 'der', 'di', 'la', 'le', 'van', 'von', 'den', 'ten', 'ter', 'du', 'st', 'san', 'mac', 'mc', 'o', 'd', 'l',
]

# States by name, countries by name or code, calling codes by country.
STATE_CODE = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS",
    "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ",
    "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR",
    "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT",
    "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC",
    "dc": "DC",
}
COUNTRY_CODE = {
    "us": "US", "usa": "US", "united states": "US", "united states of america": "US", "u.s.": "US", "u.s.a.": "US", "america": "US", "canada": "CA",
    "ca": "CA", "mexico": "MX", "mx": "MX", "united kingdom": "GB", "uk": "GB", "u.k.": "GB", "great britain": "GB", "england": "GB",
    "scotland": "GB", "wales": "GB", "northern ireland": "GB", "ireland": "IE", "republic of ireland": "IE", "germany": "DE", "deutschland": "DE",
    "de": "DE", "france": "FR", "fr": "FR", "italy": "IT", "it": "IT", "spain": "ES", "es": "ES", "portugal": "PT", "pt": "PT", "netherlands": "NL",
    "holland": "NL", "nl": "NL", "belgium": "BE", "be": "BE", "switzerland": "CH", "ch": "CH", "austria": "AT", "at": "AT", "australia": "AU",
    "au": "AU", "new zealand": "NZ", "nz": "NZ", "india": "IN", "in": "IN", "china": "CN", "cn": "CN", "people's republic of china": "CN",
    "prc": "CN", "japan": "JP", "jp": "JP", "south korea": "KR", "republic of korea": "KR", "kr": "KR", "brazil": "BR", "br": "BR",
    "argentina": "AR", "ar": "AR", "south africa": "ZA", "za": "ZA", "sweden": "SE", "se": "SE", "norway": "NO", "no": "NO", "denmark": "DK",
    "dk": "DK", "finland": "FI", "fi": "FI", "czech republic": "CZ", "czechia": "CZ", "cz": "CZ", "poland": "PL", "pl": "PL", "singapore": "SG",
    "sg": "SG", "hong kong": "HK", "hk": "HK", "israel": "IL", "il": "IL", "united arab emirates": "AE", "uae": "AE", "ae": "AE",
}
CALLING_CODE = {
    "US": "1", "CA": "1", "GB": "44", "IE": "353", "DE": "49", "FR": "33", "IT": "39", "ES": "34", "PT": "351", "NL": "31", "BE": "32", "CH": "41",
    "AT": "43", "AU": "61", "NZ": "64", "IN": "91", "CN": "86", "JP": "81", "KR": "82", "BR": "55", "AR": "54", "ZA": "27", "SE": "46", "NO": "47",
    "DK": "45", "FI": "358", "CZ": "420", "PL": "48", "SG": "65", "HK": "852", "IL": "972", "AE": "971", "MX": "52",
}

# Words of a street line.
STREET_WORDS = [
    "street", "st", "road", "rd", "avenue", "ave", "boulevard", "blvd", "lane", "ln", "drive", "dr", "court", "ct", "circle", "cir", "way", "parkway", "pkwy",
    "highway", "hwy", "trail", "trl", "loop", "plaza", "plz", "suite", "ste", "unit", "apt", "apartment", "floor", "fl", "building", "bldg",
]

# Order of trust of the sources, labels of address-book exports, hobby words, default cities.
SOURCE_PRIORITY = {"linkedin": 3, "mac_vcf": 2, "gmail": 1}
APPLE_LABELS = {"_$!<work>!$_": "work", "_$!<home>!$_": "home", "_$!<other>!$_": "other"}
MARTIAL_ARTS = r"tai\s*chi|wu\s*an|wu\s*dao|kung\s*fu|shaolin|martial\s*arts"
NUTCRACKER = r"nutcracker|\bcherub(s)?\b|jose\s*mateo|ballet"
LOCAL_CITIES = [
    "braintree", "quincy", "weymouth", "dedham", "milton", "hingham", "needham", "brookline", "cambridge", "somerville", "boston",
]
UUID_NAMESPACE = "12345678123456781234567812345678"
