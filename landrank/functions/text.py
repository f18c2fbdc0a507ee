"""Text: keys, labels, patterns, parsers and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that mark entities and governments in names, use classes, value bases, and what is vetoed.
ENTITY = (r"(?i)\b(LLC|L\.L\.C|INC|INCORPORATED|CORP|CORPORATION|COMPANY|CO|LP|LLP|LTD|TRUST|TRUSTEE|ASSOC|ASSOCIATION|"
          r"PROPERTIES|HOLDINGS|PARTNERS|PARTNERSHIP|CHURCH|FOUNDATION|BANK)\b")
GOVERNMENT = r"(?i)\b(STATE OF|COUNTY OF|CITY OF|TOWN OF|USA|UNITED STATES|FOREST SERVICE|NATIONAL PARK|DEPARTMENT OF)\b"
GOVERNMENT_USES = ("GOVERNMENT", "EXCLUSIONS (COMMONE AREAS)")
VALUE_BASES = {"ASSESSED": "market_equivalent", "MARKET": "market_equivalent", "APPRAISED": "market_equivalent", "TAXABLE": "net_of_exemptions"}
SFHA_ZONES = ("A", "AE", "AH", "AO", "AR", "A99", "V", "VE", "A1-A30", "V1-V30")
FLOOD_OUT_SCORE, FLOOD_OUT_SITE = r"(?i)^(X|B|C)", r"(?i)^(X|C|B)$"
REGIMES = {46006: "perennial", 46003: "intermittent", 46007: "ephemeral"}
WATERCOURSE = 460
PERENNIAL_BODIES, PERENNIAL_RANGE = (39000, 39004, 39009, 39010, 39011, 39012), (43600, 43626)
ROAD_CLASSES = {"S1100": "primary", "S1200": "secondary", "S1400": "local", "S1500": "vehicular-trail-4wd", "S1630": "ramp",
                "S1640": "service-drive", "S1740": "private-service"}
NOTICES = (("tax-foreclosure", r"(?i)tax\s*foreclosure"), ("sale-under-power", r"(?i)sale\s+under\s+power"), ("sheriff-sale", r"(?i)sheriff'?s?\s+sale"))

UNCLASSIFIED = "UNCLASSIFIED"


def normal_key(x: Column) -> Column:
    """Trimmed, upper case, without white space; null is empty."""
    return F.regexp_replace(F.upper(F.trim(F.coalesce(x, F.lit("")))), r"\s+", "")


def record_id(fips: Column, parno: Column, seq: Column) -> Column:
    return F.concat_ws(":", fips, parno, seq.cast("string"))


def use_bucket(x: Column) -> Column:
    flat = F.upper(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")))
    return F.when(flat == "", UNCLASSIFIED).otherwise(flat)


def band(x: Column, edges: list[float]) -> Column:
    """Label of the band (lower, upper] that holds x; the last is open.  Null and what is not positive have none."""
    name = lambda e: f"{e:g}"
    out, low = F.when(x.isNull() | F.isnan(x) | (x <= 0), F.lit(None).cast("string")), 0.0
    for e in edges:
        out = out.when(x <= e, f"{name(low)}-{name(e)}")
        low = e
    return out.otherwise(f"{name(low)}+")


def cohort_key(fips: Column, use: Column, acreage: Column, edges: list[float]) -> Column:
    b = band(acreage, edges)
    return F.when(b.isNotNull() & (F.coalesce(fips, F.lit("")) != ""), F.concat_ws("|", fips, use_bucket(use), b))


def value_basis(raw: Column) -> Column:
    x, out = F.upper(F.trim(raw)), None
    for k, v in VALUE_BASES.items():
        out = F.when(x == k, v) if out is None else out.when(x == k, v)
    return out.otherwise("unknown")


def is_government(name: Column, use: Column) -> Column:
    return F.coalesce(name.rlike(GOVERNMENT), F.lit(False)) | F.coalesce(F.upper(F.trim(use)).isin(*GOVERNMENT_USES), F.lit(False))


def is_entity(name: Column) -> Column:
    return F.when(F.coalesce(F.trim(name), F.lit("")) != "", name.rlike(ENTITY))


def sfha(zone: Column) -> Column:
    """Whether a flood zone is a special hazard area; zone D is undetermined and null."""
    z = F.upper(F.trim(zone))
    return F.when(z == "D", F.lit(None).cast("boolean")).otherwise(z.isin(*SFHA_ZONES))


def flood_out(zone: Column, exact: bool = False) -> Column:
    """Outside the flood plain: by prefix, as scores take it, or exactly, as listings do."""
    return zone.rlike(FLOOD_OUT_SITE if exact else FLOOD_OUT_SCORE)


def regime(fcode: Column) -> Column:
    out = None
    for k, v in REGIMES.items():
        out = F.when(fcode == k, v) if out is None else out.when(fcode == k, v)
    return out.otherwise("unspecified")


def is_perennial_body(fcode: Column) -> Column:
    return fcode.isin(*PERENNIAL_BODIES) | fcode.between(*PERENNIAL_RANGE)


def road_class(code: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ROAD_CLASSES.items() for x in kv])[code], code)


def classify(title: Column) -> Column:
    """A notice's kind by its title."""
    out = None
    for kind, pattern in NOTICES:
        out = F.when(title.rlike(pattern), kind) if out is None else out.when(title.rlike(pattern), kind)
    return out.otherwise("county-notice")


def sale_date(text: Column) -> Column:
    """The first "Month D, YYYY" of a text as YYYY-MM-DD; null rather than a guess."""
    part = lambda k: F.regexp_extract(
        text, r"(?i)\b(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{1,2}),?\s+(\d{4})", k)
    said = F.concat_ws(" ", F.initcap(part(1)), part(2), part(3))
    return F.date_format(F.try_to_timestamp(F.when(part(1) != "", said), F.lit("MMMM d yyyy")), "yyyy-MM-dd")


def money(text: Column) -> Column:
    bare = F.trim(F.regexp_replace(text, r"[$,\s]", ""))
    return F.when(~bare.isin("", "-"), bare.try_cast("double"))


def entities_decoded(text: Column) -> Column:
    for a, b in (("&amp;", "&"), ("&#39;", "'"), ("&quot;", '"'), ("&nbsp;", " ")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def is_bare_origin(url: Column) -> Column:
    """A URL without path, query or fragment points to no record."""
    return url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?$")


def record_url(base: Column, where: Column) -> Column:
    return F.concat(base, F.lit("/query?where="), F.url_encode(where), F.lit("&outFields=*&f=html"))


# -- formats: null is why it is unknown ------------------------------------------------------------------------------

def _or_dash(x: Column, shown: Column) -> Column:
    return F.when(x.isNull(), "unknown").otherwise(shown)


def show_money(x: Column) -> Column:
    return _or_dash(x, F.concat(F.lit("$"), F.format_number(F.floor(x + 0.5), 0)))


def show_acres(x: Column) -> Column:
    return _or_dash(x, F.concat(F.format_number(x, 1), F.lit(" ac")))


def show_distance(x: Column) -> Column:
    return _or_dash(x, F.when(x < 1000, F.concat(F.format_number(F.floor(x + 0.5), 0), F.lit(" m"))).otherwise(
        F.concat(F.format_number(x / 1000, 1), F.lit(" km"))))


def show_percent(x: Column) -> Column:
    return _or_dash(x, F.concat(F.format_number(F.floor(x + 0.5), 0), F.lit("%")))
