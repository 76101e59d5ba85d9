"""Normalisers as column expressions: names, places, phones, addresses, URLs, dates, numbers, hashes.

Each rule keeps its own function; they differ on purpose and do not stand in for one another. All are built-in
expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry a legal form.
LEGAL_WORDS = ["inc", "llc", "l l c", "corp", "corporation", "co", "company", "ltd", "the"]
# City words written out.
CITY_WORDS = {"st": "saint", "ste": "sainte", "mt": "mount", "ft": "fort"}
# City words abbreviated.
CITY_SHORT = {"fort": "ft", "mount": "mt", "saint": "st"}
# States by name.
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO",
    "connecticut": "CT", "delaware": "DE", "district of columbia": "DC", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS",
    "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA",
    "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT",
    "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM",
    "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK",
    "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD",
    "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}
# Hosts that many firms share.
SHARED_HOSTS = ["facebook.com", "google.com", "sites.google.com", "linkedin.com", "yelp.com", "business.site", "wixsite.com", "godaddysites.com", "instagram.com", "twitter.com", "x.com", "mapquest.com", "bbb.org", "yellowpages.com"]
# Words of a street that say nothing about which street it is.
STREET_NOISE = ["ST", "STREET", "RD", "ROAD", "AVE", "AVENUE", "BLVD", "BOULEVARD", "DR", "DRIVE", "LN", "LANE", "WAY", "CT", "COURT", "PL", "PLACE", "HWY", "HIGHWAY", "PKWY", "PARKWAY", "N", "S", "E", "W", "NE", "NW", "SE", "SW", "STE", "SUITE", "UNIT", "BLDG", "BUILDING", "PO", "BOX", "ATTN"]


def blank(c: Column) -> Column:
    """Null and blank text are one: null."""
    return F.nullif(F.trim(c), F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def plain(c: Column) -> Column:
    """Lower case, everything but a-z, 0-9 and space as a space, single spaces."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", " "))


def light_name(c: Column) -> Column:
    return plain(c)


def norm_name(c: Column) -> Column:
    """plain() without the words of a legal form."""
    return squeeze(F.regexp_replace(plain(c), r"\b(" + "|".join(LEGAL_WORDS) + r")\b", " "))


def name_key(c: Column) -> Column:
    return F.replace(norm_name(c), F.lit(" "), F.lit(""))


def alnum(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def tokens(c: Column) -> Column:
    """Distinct words of plain()."""
    return F.array_distinct(F.filter(F.split(plain(c), " "), lambda t: t != ""))


def distinctive_tokens(c: Column, generic: list[str]) -> Column:
    """Words that tell one name from another: not generic, of two letters or more, not a number."""
    return F.filter(tokens(c), lambda t: (F.length(t) > 1) & ~t.rlike("^[0-9]+$") & ~t.isin(generic))


def mapped_words(c: Column, words: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def norm_city(c: Column) -> Column:
    """City words written out: st louis is saint louis."""
    return mapped_words(plain(c), CITY_WORDS)


def city_key(c: Column) -> Column:
    """City words abbreviated and joined: Saint Louis is stlouis."""
    words = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", "")
    for word, short in CITY_SHORT.items():
        words = F.regexp_replace(words, rf"\b{word}\b", short)
    return F.replace(words, F.lit(" "), F.lit(""))


def us_state(c: Column) -> Column:
    """The code of a state given by code or name, else ''. Nothing is cut to a code."""
    s = squeeze(F.coalesce(c, F.lit("")))
    names = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    return F.when(F.upper(s).isin(sorted(STATES.values())), F.upper(s)).otherwise(F.coalesce(F.element_at(names, F.lower(s)), F.lit("")))


def phone_digits(c: Column) -> Column:
    """Ten digits, a leading country code 1 dropped; else ''."""
    d = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    return F.when(F.length(d) == 10, d).otherwise("")


def phone_last10(c: Column) -> Column:
    d = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(d) >= 10, F.right(d, F.lit(10))).otherwise("")


def zip5(c: Column) -> Column:
    d = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(d) >= 5, F.left(d, F.lit(5))).otherwise("")


def trailing_zip(c: Column) -> Column:
    """The five digits that end an address, with or without four more; else ''."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"([0-9]{5})(-[0-9]{4})?\s*$", 1)


def house_number(c: Column) -> Column:
    return F.regexp_extract(F.split_part(F.coalesce(c, F.lit("")), F.lit(","), F.lit(1)), r"^\s*([0-9]+)\b", 1)


def physical_street(c: Column) -> Column:
    """Starts with a house number and is no post box."""
    return F.coalesce(c.rlike(r"^\s*[0-9]+\s+\S") & ~F.lower(c).rlike(r"p\.?\s*o\.?\s*box"), F.lit(False))


def place_words(c: Column) -> Column:
    """Words of three letters or more of an address that tell its street, sorted."""
    words = F.split(squeeze(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9 ]", " ")), " ")
    return F.sort_array(F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 3) & ~w.rlike("^[0-9]+$") & ~w.isin(STREET_NOISE))))


def place_number(c: Column) -> Column:
    """The first word of an address that is all digits, else ''."""
    words = F.split(squeeze(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9 ]", " ")), " ")
    return F.coalesce(F.get(F.filter(words, lambda w: w.rlike("^[0-9]+$")), F.lit(0)), F.lit(""))


def host(c: Column) -> Column:
    """The host of a URL with or without a scheme, without www., else ''."""
    s = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    h = F.regexp_extract(s, r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#]*)", 1)
    return F.regexp_replace(h, r"^www\.", "")


def own_domain(c: Column) -> Column:
    """host() unless it is no domain or one that many share."""
    h = host(c)
    shared = F.lit(False)
    for s in SHARED_HOSTS:
        shared = shared | (h == s) | h.endswith("." + s)
    return F.when(h.contains(".") & ~shared, h).otherwise("")


def homepage(c: Column) -> Column:
    return F.when(host(c) != "", F.concat(F.lit("https://"), host(c), F.lit("/"))).otherwise("")


def source_kind(url: Column, own_host: Column) -> Column:
    """What a cited page is, by the first rule that holds."""
    h, u = host(url), F.lower(F.coalesce(url, F.lit("")))
    return (
        F.when((h != "") & (h == own_host), "company_site")
        .when(h.endswith("sec.gov") | u.contains("/filing"), "filing")
        .when(h.endswith(".gov") & u.rlike("permit"), "permit")
        .when(h.endswith(".gov") | h.rlike(r"\.state\.[a-z]{2}\.us$"), "registry_page")
        .when(h.isin(SHARED_HOSTS[:1] + SHARED_HOSTS[3:4] + SHARED_HOSTS[8:11]), "social")
        .when(h.rlike(r"^maps\.|mapquest"), "map")
        .when(h.rlike("directory|yellowpages|yelp"), "directory")
        .otherwise("other")
    )


def iso_date(c: Column) -> Column:
    """ISO text of a date in one of four notations, else ''."""
    s = F.trim(F.coalesce(c, F.lit("")))
    parts = [F.when(s.rlike(p), F.try_to_date(s, f)) for p, f in ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"), (r"^[A-Z][a-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"))]
    return F.coalesce(F.date_format(F.coalesce(*parts), "yyyy-MM-dd"), F.lit(""))


def quarter(c: Column) -> Column:
    """2024Q1 of an ISO date text, null if it is none."""
    d = F.try_to_date(c, "yyyy-MM-dd")
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def plausible_number(c: Column, low: float = 0, high: float = float("inf")) -> Column:
    """The first number in a text as a whole number's text if it lies within [low, high], else null."""
    n = F.regexp_replace(F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), r"([0-9][0-9,]*(\.[0-9]+)?)", 1), ",", "").try_cast("double")
    return F.when((n >= low) & (n <= high), F.bround(n, 0).cast("long").cast("string"))


def parse_lat_lon(c: Column) -> tuple[Column, Column]:
    part = F.split(c, ",")
    lat, lon = F.trim(F.get(part, F.lit(0))).try_cast("double"), F.trim(F.get(part, F.lit(1))).try_cast("double")
    good = (F.size(part) == 2) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(good, lat), F.when(good, lon)


def hashed(*cols: Column, length: int = 16) -> Column:
    """First hex digits of the SHA-256 of the columns, each followed by the unit separator."""
    parts = [x for c in cols for x in (F.coalesce(c.cast("string"), F.lit("")), F.lit("\x1f"))]
    return F.substring(F.sha2(F.concat(*parts), 256), 1, length)


def whole_word_prefix(a: Column, b: Column) -> Column:
    """The shorter name begins the longer at a word's end and has two words or eight letters."""
    short = F.when(F.length(a) < F.length(b), a).otherwise(b)
    long = F.when(F.length(a) < F.length(b), b).otherwise(a)
    return (a != "") & (b != "") & (a != b) & (short.contains(" ") | (F.length(short) >= 8)) & long.startswith(F.concat(short, F.lit(" ")))


def minor_correction(a: Column, b: Column, most: int = 2) -> Column:
    return F.levenshtein(F.lower(a), F.lower(b)) <= most


def quoted(quote: Column, page: Column) -> Column:
    """The quote stands in the page word for word, white space aside."""
    q = squeeze(F.coalesce(quote, F.lit("")))
    return (q != "") & (F.instr(squeeze(page), q) > 0)


def check_value(field: Column, value: Column, taxonomy: list[str]) -> Column:
    """Why a value does not fit its field; null if it does."""
    n = value.try_cast("double")
    lat, _ = parse_lat_lon(value)
    return (
        F.when(F.trim(F.coalesce(value, F.lit(""))) == "", "blank")
        .when((field == "state") & (us_state(value) != value), "not a state code")
        .when((field == "zip") & ~value.rlike(r"^[0-9]{5}(-[0-9]{4})?$"), "not a ZIP code")
        .when((field == "lat_lon") & lat.isNull(), "not a coordinate")
        .when((field == "website") & ~host(value).contains("."), "not a URL")
        .when((field == "email") & ~value.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), "not an e-mail address")
        .when((field == "phone") & (phone_digits(value) == ""), "not a phone number")
        .when((field == "sq_ft") & ~F.coalesce(n.between(500, 20000000), F.lit(False)), "out of range")
        .when((field == "capability") & ~value.isin(taxonomy), "not in the taxonomy")
    )
