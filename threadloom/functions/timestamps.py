"""Parsing of mixed timestamp notations with built-in expressions only (no Python on executors).

A notation family is one regular expression; a match is rewritten to the field list
``year, month, day, hour, minute, second, fraction, am/pm, zone`` in one pass and split.  The parsed
struct keeps the wall-clock reading and, where the text names one, the offset; the caller supplies
zone and day/month order for texts that do not.
"""

from __future__ import annotations

from collections.abc import Callable
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\x01"

# Month names and abbreviations (en, de, fr, es, it, pt).
MONTHS = {
    1: "january jan januar jän jänner janvier janv enero ene gennaio gen janeiro",
    2: "february feb februar février févr fevrier febrero febbraio febb fevereiro fev",
    3: "march mar märz mrz maerz mars marzo março marco",
    4: "april apr avril avr abril abr aprile",
    5: "may mai mayo maggio mag maio",
    6: "june jun juni juin junio giugno giu junho",
    7: "july jul juli juillet juil julio luglio lug julho",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre settembre set setembro",
    10: "october oct oktober okt octobre octubre ottobre ott outubro out",
    11: "november nov novembre noviembre novembro",
    12: "december dec dezember dez décembre déc decembre diciembre dic dicembre dezembro",
}
# Zone abbreviations in mail and log timestamps, offset in minutes.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "mez": 60,
    "cest": 120, "mesz": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330, "jst": 540, "acst": 570,
    "aest": 600, "aedt": 660, "acdt": 630, "awst": 480, "nzst": 720, "nzdt": 780, "brt": -180, "brst": -120,
    "art": -180, "ast": -240, "adt": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420,
    "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "hkt": 480, "sgt": 480,
}

# Abbreviations of several countries' times.  Where the account's zone has one of these offsets at the
# time in question, that one is meant, else the one above.
SHARED_ABBREVIATIONS = {
    "ist": [330, 60, 120], "bst": [60, 360], "cst": [-360, 480], "est": [-300, 600], "edt": [-240, 660], "ast": [-240, 180], "amt": [-240, 240], "ect": [-300, 60],
}

_TIME = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,](\d+))?)?"
_AP = r"\s*(?:([ap])\.?\s?m\.?)?"
_ZONE = (
    r"\s*(?:uhr|h)?\s*(?:(z|(?:utc|gmt|ut)?\s?[+-]\d{1,2}(?::?\d{2})?|[a-z]{2,5}|[a-z_]+(?:/[a-z_+\-0-9]+)+)"
    r"(?:\s*\[[^\]]*\]|\s*\([^)]*\)|\s+[a-z_]+(?:/[a-z_]+)+)?)?"
)
_WEEKDAY = r"(?:\p{L}{2,12}\.?,?\s+)?"
_OF = r"(?:de\s+|of\s+|di\s+)?"
_AT = r"(?:um\s+|at\s+|à\s+|alle\s+|ore\s+|às\s+|a\s+las\s+)?"

#: (pattern, replacement groups) — the field list in the order of the docstring; "" is an absent field.
FAMILIES: dict[str, tuple[str, list[str]]] = {
    "iso": (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:t|\s|,\s?){_TIME}{_AP}{_ZONE}$", "$1 $2 $3 $4 $5 $6 $7 $8 $9".split()),
    "compact": (
        rf"^((?:19|20)\d{{2}})(\d{{2}})(\d{{2}})t?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d+))?{_ZONE}$",
        ["$1", "$2", "$3", "$4", "$5", "$6", "$7", "", "$8"],
    ),
    "day_month": (
        rf"^{_WEEKDAY}(\d{{1,2}})(?:st|nd|rd|th|\.)?[\s-]+{_OF}(\p{{L}}{{3,12}})\.?,?[\s-]+{_OF}(\d{{4}}|\d{{2}}),?\s+{_AT}{_TIME}{_AP}{_ZONE}$",
        "$3 $2 $1 $4 $5 $6 $7 $8 $9".split(),
    ),
    "month_day": (
        rf"^{_WEEKDAY}(\p{{L}}{{3,12}})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}),?\s+{_AT}{_TIME}{_AP}{_ZONE}$",
        "$3 $1 $2 $4 $5 $6 $7 $8 $9".split(),
    ),
    "numeric": (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}})(?:,\s*|\s+){_TIME}{_AP}{_ZONE}$", "$3 $2 $1 $4 $5 $6 $7 $8 $9".split()),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` evaluated once.

    Catalyst inlines a projected expression into each of its uses; through a lambda variable the regular
    expressions below run once per row and the generated code stays small.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean(text: Column) -> Column:
    """Without invisible marks, odd spaces, outer blanks and one pair of outer brackets."""
    x = F.translate(text, _DROPPED_OR_MAPPED[0], _DROPPED_OR_MAPPED[1])
    return F.regexp_replace(x, r"^\s*\[?([^\[]*?)\s*\]?\s*$|^\s+|\s+$", "$1")


# Unusual spaces and digits become plain ones; invisible marks have no counterpart and are dropped.
_SPACES = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t\r\n"
_DIGITS = "०१२३४५६७८९٠١٢٣٤٥٦٧٨٩"
_MARKS = "\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2066\u2067\u2068\u2069\ufeff"
_DROPPED_OR_MAPPED = (_SPACES + _DIGITS + "−" + _MARKS, " " * len(_SPACES) + "01234567890123456789" + "-")


def _month(name: Column) -> Column:
    table = [F.lit(x) for k, names in MONTHS.items() for n in names.split() for x in (n, k)]
    return F.coalesce(name.try_cast("int"), F.try_element_at(F.create_map(*table), F.lower(name)))


def parse_fields(text: Column) -> Column:
    """Struct of parsed fields; all null where the text is in no known notation.

    ``family``, ``y, a, b`` (``a``: month and ``b``: day as in day-first order), ``h, mi, s, us``, ``zone``,
    ``epoch_us`` for bare numbers since 1970.
    """
    return let(clean(text), _parse_clean)


def _parse_clean(x: Column) -> Column:
    epoch = F.when(x.rlike(r"^\d{10}(?:[.,]\d+)?$|^\d{13}$|^\d{16}$|^\d{19}$"), "epoch")
    families = [(name, f"(?iu){p}", groups) for name, (p, groups) in FAMILIES.items()]

    def attempt(k: int) -> Column:
        if k == len(families):
            return epoch
        name, p, groups = families[k]
        return let(F.regexp_replace(x, p, SEP.join([name, *groups])), lambda r: F.when(r.contains(SEP), r).otherwise(attempt(k + 1)))

    return let(F.split(attempt(0), SEP), lambda part: _fields_of(x, part))


def _fields_of(x: Column, part: Column) -> Column:
    family = part[0]
    get = lambda i: F.nullif(F.get(part, F.lit(i + 1)), F.lit(""))
    hour, ap = get(3).try_cast("int"), F.lower(get(7))
    hour = F.when(ap.isNull(), hour).when((hour >= 1) & (hour <= 12), hour % 12 + F.when(ap == "p", 12).otherwise(0))
    year = get(0).try_cast("int")
    n = F.length(x)
    number = F.regexp_replace(x, "[.,].*$", "").try_cast("decimal(20,0)")
    fraction = F.rpad(F.substring(F.regexp_extract(x, r"^\d+[.,](\d+)$", 1), 1, 6), 6, "0").try_cast("long")
    epoch = (
        F.when((n == 13), number * 1000).when(n == 16, number).when(n == 19, F.floor(number / 1000)).otherwise(number * 1_000_000)
    ).cast("long") + F.coalesce(fraction, F.lit(0))
    return F.struct(
        family.alias("family"),
        F.when(F.length(get(0)) == 2, year + 2000).otherwise(year).alias("y"),
        _month(get(1)).alias("a"),
        get(2).try_cast("int").alias("b"),
        hour.alias("h"),
        get(4).try_cast("int").alias("mi"),
        F.coalesce(get(5).try_cast("int"), F.lit(0)).alias("s"),
        F.coalesce(F.rpad(F.substring(get(6), 1, 6), 6, "0").try_cast("long"), F.lit(0)).alias("us"),
        get(8).alias("zone"),
        F.when(family == "epoch", epoch).alias("epoch_us"),
    )


def wall_clock(p: Column, order: Column) -> Column:
    """TIMESTAMP_NTZ of the fields (whole seconds) under a day/month order; null where impossible."""
    mdy = (p["family"] == "numeric") & F.coalesce(F.lower(order) == "mdy", F.lit(False))
    month, day = F.when(mdy, p["b"]).otherwise(p["a"]), F.when(mdy, p["a"]).otherwise(p["b"])
    ok = (p["h"] < 24) & (p["mi"] < 60) & (p["s"] < 60) & month.between(1, 12) & (day >= 1) & (p["y"] >= 1)
    return F.when(ok, F.try_make_timestamp_ntz(p["y"], month, day, p["h"], p["mi"], p["s"].cast("decimal(16,6)")))


def ntz_seconds(x: Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session's time zone."""
    return (F.unix_date(x.cast("date")).cast("long") * 86400 + F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x)).cast("long")


def known_zone(zone: Column) -> Column:
    """The zone where it is an IANA id that exists, else null."""
    return F.when(zone.isin(*sorted(available_timezones() - {"localtime", "Factory"})), zone)


def to_utc_seconds(wall: Column, zone: Column) -> Column:
    """A wall clock in a zone as UTC seconds; the first where it occurs twice, null where it never does."""
    utc = F.convert_timezone(zone, F.lit("UTC"), wall)
    return F.when(F.convert_timezone(F.lit("UTC"), zone, utc) == wall, ntz_seconds(utc))


def stated_offset(zone: Column) -> Column:
    """Offset in seconds that the text itself states as numbers; null without one."""
    m = F.split(F.regexp_replace(zone, r"(?i)^(?:utc|gmt|ut)?\s?([+-])(\d{1,2}):?(\d{2})?$", f"$1{SEP}$2{SEP}$3"), SEP)
    size = m[1].try_cast("int") * 3600 + F.coalesce(m[2].try_cast("int"), F.lit(0)) * 60
    return F.when(F.size(m) == 3, F.when(m[0] == "-", -size).otherwise(size)).cast("long")


def abbreviation_offset(zone: Column, own: Column | None = None) -> Column:
    """Offset in seconds of an abbreviation; ``own``, the offset of the account's zone then, decides between countries."""
    table = F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k, v * 60)])
    usual = F.try_element_at(table, F.lower(zone)).cast("long")
    if own is None:
        return usual
    shared = F.create_map(*[x for k, v in SHARED_ABBREVIATIONS.items() for x in (F.lit(k), F.array(*[F.lit(o * 60).cast("long") for o in v]))])
    return F.when(F.array_contains(F.try_element_at(shared, F.lower(zone)), own), own).otherwise(usual)


def instant_us(p: Column, zone: Column, order: Column) -> Column:
    """Microseconds since 1970-01-01 UTC, or null where the text does not denote one instant.

    Finer digits are cut off, missing seconds are 0.  A zone in the text wins over ``zone``; an unknown
    zone name or offset beyond 18 hours denotes nothing.  ``zone`` must have passed ``known_zone``.
    """
    seconds = let(wall_clock(p, order), lambda wall: _utc_seconds(p, wall, zone))
    return F.coalesce(p["epoch_us"], seconds * 1_000_000 + p["us"])


def _utc_seconds(p: Column, wall: Column, zone: Column) -> Column:
    named = known_zone(p["zone"])
    several = F.lower(p["zone"]).isin(*SHARED_ABBREVIATIONS)
    own = F.when(several, ntz_seconds(wall) - to_utc_seconds(wall, zone))
    offset = F.coalesce(stated_offset(p["zone"]), abbreviation_offset(p["zone"], own))
    bare = p["zone"].isNull() | (F.lower(p["zone"]) == "local")
    return (
        F.when(bare, to_utc_seconds(wall, zone))
        .when(F.abs(offset) <= 18 * 3600, ntz_seconds(wall) - offset)
        .when(named.isNotNull(), to_utc_seconds(wall, named))
    )
