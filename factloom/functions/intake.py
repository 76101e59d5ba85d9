"""What records are read into before they are facts: addresses in parts, names of establishments, values made comparable, vetoes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.text import STATES, alnum, host, norm_name, us_state

# Short forms and dropped words of intake keys, provinces, forms of firms.
SHORT_WORDS = {"street": "st", "road": "rd", "avenue": "ave", "highway": "hwy", "drive": "dr", "boulevard": "blvd", "lane": "ln", "north": "n", "south": "s", "east": "e", "west": "w", "parkway": "pkwy", "court": "ct"}
DROPPED = "inc llc corp corporation co company ltd the of".split()
PROVINCES = {"alberta": "AB", "british columbia": "BC", "manitoba": "MB", "new brunswick": "NB", "newfoundland": "NL", "nova scotia": "NS", "ontario": "ON", "quebec": "QC", "saskatchewan": "SK", "prince edward island": "PE"}
FIRM_WORDS = "inc llc co corp the ltd company".split()
# The median footprint by industry, in square feet, that of all, and the share that is small.
MEDIAN_SQFT = {"332311": 49534, "321214": 14145, "321991": 87303, "321992": 18894, "321213": 25404, "332312": 50008}
ANY_SQFT, SMALL = 33236, 0.20
# Mailboxes nobody reads, words before an identification number, words before a phone, pages of registers.
NO_MAILBOX = r"^(?i)(no-?text|no-?sms|no-?reply|do-?not-?reply|unsubscribe|opt-?out|stop|bounce|mailer-daemon)\b"
ID_NUMBER = r"(?i)\b(taxpayer|tax\s*id|ein|fein|tin|license|licen[cs]e\s*(no|#|number)|lic\s*#|usdot|dot\s*(no|#|number)|mc\s*#|npi|duns|uei|cage|account|registration\s*(no|#|number)|document\s*(no|#|number))\b"
PHONE_WORD = r"(?i)\b(phone|tel|telephone|call|ph|main|office|toll[\s-]*free|contact)\b"
REGISTER = r"(?i)taxpayer|tax-?id|\bein\b|licen[cs]e|corporation|entity|duns|uei|registr"


def _known(words: dict[str, object], c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in words.items() for x in kv]), c)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def intake_key(c: Column) -> Column:
    """Lower-case words, street words shortened, forms of firms dropped: for comparing, not for keeping."""
    words = F.filter(F.split(F.regexp_replace(F.lower(_text(c)), "[^a-z0-9 ]+", " "), " +"), lambda w: (w != "") & ~w.isin(DROPPED))
    return F.array_join(F.transform(words, lambda w: F.coalesce(_known(SHORT_WORDS, w), w)), " ")


def split_address(c: Column) -> Column:
    """(street, city, state, zip, country) of one line; what does not match is a street and nothing else.

    A ZIP+4 that a line end broke is mended; states may be written out; Canadian lines name the province.
    """
    line = F.trim(F.regexp_replace(_text(c), r"\s+", " "))
    line = F.regexp_replace(F.regexp_replace(line, r"(\d{5})\s*-\s+(\d{4})\b", "$1-$2"), r"(\d{5})\s*-\s*$", "$1")
    # The last part before the ZIP may be a state's name.
    names = "|".join(sorted(STATES, key=len, reverse=True))
    named = F.regexp_extract(line, rf"(?i),\s*({names})\b(?=[^,]*$)", 1)
    line = F.when(named != "", F.regexp_replace(line, rf"(?i),\s*({names})\b(?=[^,]*$)", F.concat(F.lit(", "), us_state(named)))).otherwise(line)
    us = r"^(.*?),\s*([^,]+),\s*([A-Z]{2})\.?(?:\s+(\d{5}(?:-\d{4})?))?\s*$"
    ca = rf"(?i)^(.*?),\s*({'|'.join(PROVINCES)})\b\s*([A-Z]\d[A-Z]\s*\d[A-Z]\d)?\s*$"
    part = lambda pattern, i: F.trim(F.regexp_extract(line, pattern, i))
    head = F.rtrim(part(ca, 1), F.lit(" ,"))
    parted = F.instr(head, ",") > 0
    street, city = F.trim(F.regexp_extract(head, "^(.*),[^,]*$", 1)), F.trim(F.regexp_extract(head, "([^,]*)$", 1))
    blank = F.lit("")
    row = lambda *cols: F.struct(*[x.alias(n) for x, n in zip(cols, ("street", "city", "state", "zip", "country"), strict=True)])
    return (
        F.when(line.rlike(us), row(part(us, 1), part(us, 2), part(us, 3), part(us, 4), F.lit("US")))
        .when(line.rlike(ca), row(F.when(parted & (street != ""), street).otherwise(head), F.when(parted & (street != ""), city).otherwise(blank), _known(PROVINCES, F.lower(part(ca, 2))), F.replace(part(ca, 3), F.lit(" "), blank), F.lit("CA")))
        .otherwise(row(line, blank, blank, blank, F.lit("US")))
    )


def split_city_state_zip(c: Column) -> Column:
    """(city, state, zip); what does not match is a city and nothing else."""
    line, shape = F.trim(_text(c)), r"^(.+?)[,\s]+([A-Z]{2})\.?\s*(\d{5}(?:-\d{4})?)?\s*$"
    hit = line.rlike(shape)
    pick = lambda i, other: F.when(hit, F.trim(F.regexp_extract(line, shape, i), F.lit(" ,"))).otherwise(other)
    return F.struct(pick(1, line).alias("city"), pick(2, F.lit("")).alias("state"), pick(3, F.lit("")).alias("zip"))


def comparable(field: Column, value: Column) -> Column:
    """A value as it is compared: by digits, code, host or letters, as its field asks."""
    v = F.trim(_text(value))
    five = F.regexp_extract(v, r"^(\d{5})", 1)
    return (
        F.when(field == "phone", F.right(F.regexp_replace(v, "[^0-9]", ""), F.lit(10)))
        .when(field == "zip", F.when(five != "", five).otherwise(alnum(v)))
        .when(field == "website", host(v))
        .when(field == "state", F.when(F.length(v) == 2, F.upper(v)).otherwise(alnum(v)))
        .when(field == "email", F.lower(v))
        .otherwise(alnum(v))
    )


def same_value(field: Column, a: Column, b: Column) -> Column:
    """Whether two values of a field say the same: names by four fifths of their words, states by code, others as comparable() has them.

    Addresses with house numbers need streets.street_rule beside this; here they compare by letters and digits.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]+", " "), " "), lambda w: (w != "") & ~w.isin(FIRM_WORDS)))
    wa, wb = words(a), words(b)
    code = lambda c: F.when(us_state(c) != "", us_state(c)).otherwise(F.upper(F.trim(_text(c))))
    ca, cb = comparable(field, a), comparable(field, b)
    return (
        F.when(field == "name", (F.size(wa) > 0) & (F.size(wb) > 0) & (F.size(F.array_intersect(wa, wb)) * 5 >= F.greatest(F.size(wa), F.size(wb)) * 4))
        .when(field == "state", code(a) == code(b))
        .otherwise((ca != "") & (ca == cb))
    )


def establishment_name(company: Column, label: Column) -> Column:
    """The company's name, with a label in full that names a site; a label that is only a place is dropped, one that holds the company stands alone."""
    c, n = F.trim(_text(company)), F.trim(_text(label))
    key_c, key_n = norm_name(c), norm_name(n)
    return (
        F.when(c == "", n)
        .when(n.rlike(r"^[A-Za-z .'\-]{2,28},\s*[A-Za-z]{2}\.?$"), c)
        .when((key_c == "") | (key_n == "") | F.contains(key_n, key_c), n)
        .otherwise(F.concat(c, F.lit(" — "), n))
    )


def millwork_only(kind: Column) -> Column:
    """A site whose kind names doors or millwork and nothing that is made of parts of buildings."""
    k = F.lower(_text(kind))
    return k.rlike("door|millwork") & ~k.rlike("truss|panel|component|manufactur|facility|plant")


def witnessed_street(street: Column, *witnesses: Column) -> Column:
    """A street, kept only where all witnesses name one state."""
    codes = F.array_distinct(F.array(*[us_state(w) for w in witnesses]))
    return F.when((F.size(codes) == 1) & (codes[0] != ""), street).otherwise("")


def vetoes(text: Column, terms: list[str]) -> Column:
    """The terms that stand in a text as whole words, longest first."""
    low = F.lower(_text(text))
    order = sorted({t.lower() for t in terms}, key=lambda t: (-len(t), t))
    # Terms are plain words, so quoting them is all a pattern needs.
    return F.filter(F.array(*[F.when(low.rlike(rf"(?<![a-z0-9])\Q{t}\E(?![a-z0-9])"), F.lit(t)) for t in order]), lambda x: x.isNotNull())


def junk_contact(field: Column, value: Column, quote: Column, url: Column) -> Column:
    """Why a contact reaches nobody, or null."""
    q, u = _text(quote), _text(url)
    digits = F.regexp_replace(q, "[^0-9]", "")
    return (
        F.when((field == "email") & F.split_part(_text(value), F.lit("@"), F.lit(1)).rlike(NO_MAILBOX), "an opt-out or no-reply mailbox")
        .when((field == "phone") & q.rlike(ID_NUMBER) & ~q.rlike(PHONE_WORD), "the quote gives an identification number, not a phone")
        .when((field == "phone") & F.trim(q).rlike(r"^\+?\d{10,}$") & F.contains(F.regexp_replace(u, "[^0-9]", ""), digits) & u.rlike(REGISTER), "the number is the page's own identifier on an ID register, not a phone")
    )


def small_footprint(naics: Column) -> Column:
    """The footprint in square feet below which a site is small for its industry."""
    return F.bround(F.coalesce(_known(MEDIAN_SQFT, F.left(_text(naics), F.lit(6))), F.lit(ANY_SQFT)) * F.lit(SMALL)).cast("long")
