"""Personal information in free text: typed spans, and the text with placeholders in their place.

Method.  Regular expressions propose spans; checksums (Luhn, mod 97, national check letters and digits) confirm
those that carry one; words near a span, inside its sentence, raise or lower its score.  Names have no shape:
they are proposed from the name parts learnt from the structured name fields of the tables (the frequent ones
broadcast as a bounded table, the others joined with the words of the texts), from
the participants of the message itself, and from slots in which a name must stand (salutations, titles,
"schrieb ...:", "speak to ...").
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import cut_lineage

KINDS = ("email", "phone", "id_number", "iban", "card", "address", "name")
PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}

_L = r"[^\W\d_]"
_UP = r"[A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĖĘĚĞĢĪĮİĶŁĻŃŅŇŐŒŘŚŞŠŤŪŮŰŲŹŻŽ]"

# --- checksums ------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    x = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in x)) % 97 == 1


def check_letter(number: str) -> bool:
    """Eight digits and the letter that belongs to their remainder by 23 (Spanish identity numbers)."""
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(number[:8]) % 23] == number[8]


# --- candidates -----------------------------------------------------------------------------------

_DIGIT = re.compile(r"\d")
# An at sign, plain or spelled out; local part and domain are matched outwards from it.
_AT = re.compile(r"@| ?[(\[{] ?at ?[)\]}] ?| @ ", re.I)
_LOCAL = re.compile(r"[A-Za-z0-9](?:[\w.+'-]*\w)?$")
_DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+", re.I)
_TOP_LEVEL = re.compile(r"[A-Za-z]{2}$")
_EDGE, _END = r"(?<![\w#@/.,+-])", r"(?![\w@]|[-./,]\d)"
PHONE = re.compile(
    _EDGE
    + r"(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ ./-]?\d{2,5}){1,4}"  # + country
    + r"|\+\d{9,13}"
    + r"|00\d{1,3}[ .-]\d{2,4}(?:[ ./-]\d{3,8}){1,3}|00\d{10,13}"  # 00 country
    + r"|\(\d{2,5}\)[ -]?\d{3,5}[ -]?\d{3,5}"  # area in brackets
    + r"|0\d{2,4}/\d{5,8}"
    + r"|\d{3}([-.])\d{3}\1\d{4})"
    + _END
)
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
CARD = re.compile(r"(?<![\w-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\w-])")
ID_SHAPES = re.compile(
    r"(?<![\w#@/.,+-])(?:(?P<letter>\d{8}[A-Z])|(?P<card>[A-Z]{1,2}\d{4,7}[A-Z]?\d{1,2})|(?P<three>\d{3}-\d{2}-\d{4})"
    r"|(?P<eleven>\d{2} \d{3} \d{3} \d{3})|(?P<twelve>\d{4} \d{4} \d{4})|(?P<cpf>\d{3}\.\d{3}\.\d{3}-\d{2})"
    r"|(?P<code>[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z])|(?P<pan>[A-Z]{5}\d{4}[A-Z]))" + _END
)

# Words near a number that say what it is (lower case, searched inside its sentence).
ID_WORDS = re.compile(
    r"passport|identity|\bid (?:number|card|no)\b|tax (?:number|id|file)|social security|ausweis|reisepass|steuernummer|steuer-id|personalausweis"
    r"|documento|identité|passeport|carte d'identité|numéro fiscal|pasaporte|\bdni\b|\bnif\b|\bcpf\b|codice fiscale|carta d'identità|passaporto|aduana|dogana|cadastro"
    r"|pehchaan|पहचान|aadhaar|आधार|அடையாள"
)
OTHER_NUMBER = re.compile(
    r"barcode|serial|serien|série|serie\b|\bseri|order|bestell|commande|pedido|ordine|parcel|paket|colis|paquete|pacco|pacote|पार्सल|ऑर्डर|பார்சல்|ஆர்டர்"
    r"|invoice|rechnung|facture|factura|fattura|fatura|tracking|model|modell|version|revision|reads\b|unterseite|etikett|code\b|scan|label\b|isbn|imei"
)
PHONE_WORDS = re.compile(
    r"\btel|phone|mobile|mobil|\bcall|\btext\b|reach|ring|whatsapp|fax|number is|\bt:|erreichen|rückruf|anruf|unter der|joindre|rappel|appel|llamar|teléfono|llame"
    r"|chiamare|telefono|ligar|telefone|नंबर|फोन|number|phone|எண்|அழை"
)
# --- addresses ------------------------------------------------------------------------------------

_CAP = rf"{_UP}[\w'’ß-]*"
_NUM = r"\d{1,4}(?: ?bis| ?ter|/?[A-Da-d])?"
_SUFFIX = r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Close|Drive|Dr|Boulevard|Blvd|Court|Ct|Place|Pl|Square|Sq|Way|Terrace|Crescent|Row|Hill|Gardens|Marg|Nagar|Gali|Salai|Path)"
ADDRESS = re.compile(
    r"(?<![\w.,#-])(?:"
    rf"{_NUM},? (?:{_CAP} ){{1,3}}{_SUFFIX}(?: Road)?"  # 14B Old Beacon Close; 188, Weaver Nagar Road
    rf"|{_NUM},? (?i:rue|avenue|av\.|boulevard|bd|impasse|place|allée|chemin|quai|cours|route)(?: (?:de la|de l'|du|des|de|d'))? ?{_CAP}(?:[ -]{_CAP}){{0,2}}"
    rf"|(?:Am|An der|An den|Im|In der|Auf der|Auf dem|Zum|Zur|Unter den) (?:{_CAP} ){{1,2}}\d{{1,4}}[a-d]?"
    rf"|{_UP}[\w-]*(?:[Ss]traße|[Ss]trasse|[Ss]tr\.|weg|gasse|platz|allee|ring|damm|ufer|steig|hof)(?: {_UP}[\w-]*)? \d{{1,4}}[a-d]?"
    rf"|(?:C/|Calle|Avenida|Avda\.?|Av\.|Plaza|Paseo|Camino|Carrer|Ronda|Travesía|Rua|Travessa|Praça|Alameda|Estrada|Largo|Via|Viale|Piazza|Corso|Vicolo|Largo|Strada)"
    rf"(?: (?:de la|de los|de las|del|de|da|do|dos|das|della|dei|di|dell'))? ?{_CAP}(?: (?:de |del |da |do |di )?{_CAP}){{0,2}},? \d{{1,4}}[A-Da-d]?"
    r")(?!\w)",
)
_ADDRESS_ANY_CASE = re.compile(ADDRESS.pattern, re.I)

# --- names ----------------------------------------------------------------------------------------

# Slots where a name follows, by language; the text before the name ends with one of these.
BEFORE_NAME = re.compile(
    r"(?:(?:^|[\n>|] *)(?:hi|hello|hey|dear|good (?:morning|afternoon|evening)|hallo|guten (?:morgen|tag|abend)|liebe|lieber|liebe frau|sehr geehrte|sehr geehrter|bonjour|cher|chère|hola|buenos días|buenas tardes|estimad[ao]|querid[ao]|ciao|buongiorno|gentile|car[ao]|olá|bom dia|boa tarde|prezad[ao]|नमस्ते|प्रिय|வணக்கம்|namaste)"
    r"|\b(?:mr|mrs|ms|miss|dr|prof|herrn?|frau|monsieur|madame|mme|m\.|don|doña|sr|sra|señora?|signora?|sig|dott|senhora?|dona|श्री|श्रीमती|திரு)\.?"
    r"|\b(?:schrieb|neighbour|neighbor|speak to|ask for|talk to|leave it with|husband|wife|father|mother|brother|sister|son|daughter|colleague|nachbarin|nachbar|meine nachbarin|bei|chez|vecin[ao]|vicin[ao]|vizinh[ao]|voisine?|hable con|con|parli con|parlare con|fale com|com|von|padosi|पड़ोसी|வீட்டு|regards from)) +$"
)
SALUTATION_END = re.compile(r"^\s*[,:!]?\s*(?:\n|$)|^,|^:")
PRODUCT_BEFORE = re.compile(r"\b(?:modello|modelo|modèle|model|modell|regal|lampe|lamp|étagère|mod\.)\s*$", re.I)
PRODUCT_AFTER = re.compile(r"^\s+(?:lamps?|shel(?:f|ves)|model|chairs?|tables?|desks?|sofas?|beds?|series|edition|regale?|lampen?)\b", re.I)

_CAPITAL = re.compile(rf"{_UP}(?<!\w.)(?<!\w['’-].)[\w\u0300-\u036f\u0900-\u0dff]*(?:['’-]{_L}+)*\.?")
_TOKEN = re.compile(rf"{_L}[\ẁ-ͯऀ-෿]*(?:['’-]{_L}+)*\.?")


ENDING_LETTERS = (3, 4, 5)


@dataclass
class NameTable:
    """Bounded tables of name parts (lower case); ``common``: those that are ordinary words too.

    ``endings``: frequent endings of the corpus's family names; ``firms``: words of the desk's own mail domains.
    """

    first: frozenset[str] = frozenset()
    last: frozenset[str] = frozenset()
    endings: frozenset[str] = frozenset()
    firms: frozenset[str] = frozenset()
    common: frozenset[str] = field(
        default_factory=lambda: frozenset(
            "mark will rose may dean amber grace hugo iris felix vera alma flora nora clara oskar linnea august robin summer april june mai von van de da maria best don al la an am in".split()
        )
    )
    parts: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        self.parts = self.first | self.last

    def last_like(self, low: str) -> bool:
        return any(low[-n:] in self.endings for n in ENDING_LETTERS)


def split_name(raw: str | None) -> list[str]:
    """Name parts of a structured name field (display name, "Last, First", decorated or with an address)."""
    if not raw:
        return []
    x = re.sub(r"<[^>]*>|\S*@\S*|[\"~()*_]|\d", " ", raw)
    if "," in x:
        a, _, b = x.partition(",")
        x = f"{b} {a}"
    return [w for w in re.findall(rf"{_L}[\ẁ-ͯऀ-෿]*(?:['’-]{_L}+)*", x) if len(w) > 1]


Span = tuple[int, int, str, float]


def sentence_around(text: str, a: int, b: int, reach: int = 90) -> tuple[str, str]:
    """The parts of the span's sentence before and after it, at most ``reach`` characters each."""
    left = text[max(0, a - reach) : a]
    cut = max((m.end() for m in _SENTENCE_END.finditer(left)), default=0)
    right = text[b : b + reach]
    m = _SENTENCE_END.search(right)
    return left[cut:], right[: m.start()] if m else right


_SENTENCE_END = re.compile(r"[.!?…।]+[\s)]+(?=\S)|[.!?।]+$|\n|:\) |[\U0001F300-\U0001FAFF] ?")


def email_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" not in text and "at" not in text.lower():
        return out
    for m in _AT.finditer(text):
        a, b = m.span()
        if m.group() == "@" and text[a - 1 : a] == " " and text[b : b + 1] == " ":
            a, b = a - 1, b + 1
        local = _LOCAL.search(text[max(0, a - 254) : a])
        domain = _DOMAIN.match(text, b)
        if local and domain and _TOP_LEVEL.search(domain.group()):  # "3 @ 12.50" is a price
            out.append((a - len(local.group()), domain.end(), "email", 0.99 if m.group() == "@" else 0.9))
    return out


def digit_lines(text: str) -> Iterator[tuple[int, int]]:
    """The lines that hold a digit; no shape below spans lines or does without."""
    stop = 0
    while m := _DIGIT.search(text, stop):
        start = text.rfind("\n", stop, m.start()) + 1 or stop
        stop = text.find("\n", m.end())
        stop = stop if stop >= 0 else len(text)
        yield start, stop


def last_end(pattern: re.Pattern, text: str) -> int:
    """Where the last match ends; -1 without one."""
    end = -1
    for m in pattern.finditer(text):
        end = m.end()
    return end


def number_spans(text: str, start: int = 0, stop: int | None = None) -> Iterator[Span]:
    """Numbers between two offsets (a line).  Of the words before a number that say what it is the nearest decides."""
    stop = len(text) if stop is None else stop
    for m in IBAN.finditer(text, start, stop):
        x = m.group().replace(" ", "")
        if 15 <= len(x) <= 34 and mod97(x):
            yield m.start(), m.end(), "iban", 0.99
    for m in ID_SHAPES.finditer(text, start, stop):
        before, after = (x.lower() for x in sentence_around(text, m.start(), m.end()))
        score = 0.3
        if m["letter"]:
            score = 0.75 if check_letter(m["letter"]) else 0.4
        elif m["three"]:
            score = 0.5
        elif m["eleven"] or m["card"] or m["code"] or m["pan"]:
            score = 0.4
        if ID_WORDS.search(before + " " + after):
            score += 0.5
        if OTHER_NUMBER.search(before) and not ID_WORDS.search(before):
            score -= 0.4
        if score >= 0.7:
            yield m.start(), m.end(), "id_number", min(score, 0.99)
    for m in CARD.finditer(text, start, stop):
        digits = re.sub(r"\D", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            before, after = sentence_around(text, m.start(), m.end())
            if not OTHER_NUMBER.search((before + " " + after).lower()):
                yield m.start(), m.end(), "card", 0.9
    for m in PHONE.finditer(text, start, stop):
        n = sum(c.isdigit() for c in m.group())
        if not 9 <= n <= 15:
            continue
        before, after = (x.lower() for x in sentence_around(text, m.start(), m.end()))
        score = 0.8 if m.group()[0] in "+(" or m.group().startswith("00") or "/" in m.group() else 0.6
        told, other = last_end(PHONE_WORDS, before), last_end(OTHER_NUMBER, before)
        if told > other:
            score += 0.2
        elif other >= 0 or OTHER_NUMBER.search(after):
            score -= 0.4 if score > 0.7 else 0.5
        if score >= 0.5:
            yield m.start(), m.end(), "phone", min(score, 0.99)


# In text without capitals street words are ordinary words as well: "2 weeks in a row", "by the way".
_NO_STREET = re.compile(r"\b(?:the|a|an|this|that|my|your|our|his|her|its|their|no|one|some|any|in|on|of|at|to|right|same|every|each|other|first|long|half|all) \w+$")


def address_spans(text: str, start: int = 0, stop: int | None = None) -> Iterator[Span]:
    """Street addresses between two offsets (a line)."""
    stop = len(text) if stop is None else stop
    for m in ADDRESS.finditer(text, start, stop):
        yield m.start(), m.end(), "address", 0.85
    for line in _SENTENCE.finditer(text, start, stop):  # sentences typed without capitals, or in nothing else
        part = line.group()
        if (part.isupper() or part.islower()) and _DIGIT.search(part):
            for m in _ADDRESS_ANY_CASE.finditer(part):
                if not _NO_STREET.search(m.group().lower()):
                    yield line.start() + m.start(), line.start() + m.end(), "address", 0.7


_SENTENCE = re.compile(r"(?:[^\n.!?]|\.(?=\s?\d)|\.(?!\s)){12,}")


def name_spans(text: str, table: NameTable, own: frozenset[str], busy: list[tuple[int, int]]) -> Iterator[Span]:
    first, last, common, parts = table.first, table.last, table.common, table.parts
    shouting = text.isupper()
    # Only known parts (in any case) and capitalised words can begin a name.
    starts = [(m.start(), m.group()) for m in _CAPITAL.finditer(text)]
    words = set(_TOKEN.findall(text))
    typed = {w for w in words if (low := w[:-1] if w[-1] == "." else w) in parts or low in own}
    if typed := {w for w in typed if w[0] == w[0].lower()}:
        starts = sorted(starts + [(m.start(), m.group()) for m in _TOKEN.finditer(text) if m.group() in typed])
    used, at, line = -1, 0, (0, -1)
    for a, w in starts:
        if a < used:
            continue
        low = w.lower()
        capital = w[0] != low[0]
        dotted = w[-1] == "."
        word, low = (w[:-1], low[:-1]) if dotted else (w, low)
        b = a + len(w)
        while at < len(busy) and busy[at][1] <= a:
            at += 1
        if at < len(busy) and busy[at][0] < b:
            continue
        is_first, is_last, is_own = low in first, low in last, low in own and len(low) > 2
        after = _TOKEN.search(text, b) if not dotted or len(word) == 1 else None
        if after:
            a2 = after.start()
            sep = text[b:a2]
            if sep in _BETWEEN:
                word2 = after.group().rstrip(".")
                b2 = a2 + len(word2)
                if not (at < len(busy) and busy[at][0] < b2):
                    low2 = word2.lower()
                    capital2 = word2[0] != low2[0]
                    awaited = not capital and is_first and BEFORE_NAME.search(text[max(0, a - 40) : a].lower()) is not None
                    usual = frozenset() if awaited else common
                    if _pair(word, low, capital, is_first, is_own, dotted, sep, word2, low2, capital2, table, own, usual, shouting) and not _product(text, a, b2):
                        used = after.end()
                        yield a, b2, "name", 0.9
                        continue
        known = is_first or is_last or is_own
        if len(word) < 2 or not (known or capital) or (not capital and low in common):
            continue
        before = text[max(0, a - 40) : a].lower()
        slot = BEFORE_NAME.search(before)
        if not known and not (slot and _looks_last(word) and low not in table.firms):
            continue
        end = a + len(word)
        if _product(text, a, end):
            continue
        score = 0.0
        if slot:
            score += 0.6 if known else 0.3
            if _STRONG_SLOT.search(before) and SALUTATION_END.match(text[end : end + 24]):
                score += 0.3
        if known and capital:
            score += 0.3 if low not in common else 0.1
            if is_last and not is_first and low not in common:
                score += 0.25
            if score < 0.5 and RECEIPT_AFTER.match(text, end):
                score += 0.4
            if a > line[1]:
                stop = text.find("\n", a)
                line = (text.rfind("\n", line[1] if line[1] > 0 else 0, a) + 1, stop if stop >= 0 else len(text))
            if line[1] - line[0] < len(word) + 40 and text[line[0] : line[1]].strip("> |\r\t") == word:  # alone on its line: a signature
                score += 0.5
        if score >= 0.5:
            yield a, end, "name", min(score, 0.95)


_BETWEEN = frozenset([" ", "  ", "\n", ", ", "\n> ", "\n| ", "\n>", "\n>> ", "\n> > "])


def _pair(word, low, capital, is_first, is_own, dotted, sep, word2, low2, capital2, table, own, common, shouting) -> bool:  # noqa: ANN001
    """Whether two neighbouring words are an (initial or) first name with a last name, or "Last, First"."""
    first, last = table.first, table.last
    is_last2 = low2 in last or low2 in own
    if sep == ", ":
        return capital == capital2 and low in last and low2 in first and low not in first
    given = is_first or (is_own and capital)
    if sep[0] == "\n":
        return given and is_last2 and capital and capital2 and low2 not in first
    if not (given or (dotted and len(word) == 1 and capital)) or capital != capital2:
        return False
    if is_last2 and low2 not in first:
        return capital or low not in common or low2 in last
    if not is_first or low2 in first or low2 in common:
        return False
    if capital:
        return (_looks_last(word2) and not shouting) or (shouting and low not in common and len(low2) >= 4 and table.last_like(low2))
    return low not in common and len(low2) >= 5 and table.last_like(low2)


def _looks_last(word: str) -> bool:
    return len(word) >= 4 and word[0].isupper() and word[1:].islower() and word.lower() not in _NOT_NAMES


# Words that begin with a capital in the slots above without being names.
_NOT_NAMES = frozenset(
    "team support sir madam damen herren kunde kundin kundenservice monsieur madame messieurs mesdames client customer service everyone there all folks "
    "order your the parcel please monday tuesday wednesday thursday friday saturday sunday montag dienstag mittwoch donnerstag freitag samstag sonntag lunes martes lundi mardi".split()
)


_STRONG_SLOT = re.compile(r"(?:^|[\n>|] *)\S+(?: \S+)? $")
RECEIPT_AFTER = re.compile(r"\s+(?:has|have|hat|hält|tiene|ha|tem|a|said|told|signed|called|wrote|answers)\s", re.I)


def _product(text: str, a: int, b: int) -> bool:
    return bool(PRODUCT_AFTER.search(text[b : b + 14]) or PRODUCT_BEFORE.search(text[max(0, a - 16) : a]))


def find_spans(text: str, table: NameTable, speaker: str | None = None) -> list[Span]:
    """Non-overlapping spans in reading order: (start, end, kind, score).  The whole text is searched."""
    spans: list[Span] = []
    spans += email_spans(text)
    for start, stop in digit_lines(text):
        if len(_DIGIT.findall(text, start, stop)) >= 5:  # no number has fewer
            spans += number_spans(text, start, stop)
        spans += address_spans(text, start, stop)
    if len(spans) > 1:
        spans = _best(spans)
    busy = [(a, b) for a, b, _, _ in spans]
    # web addresses hold no names
    if "www." in text or "://" in text:
        busy = sorted(busy + [m.span() for m in re.finditer(r"\b(?:https?://|www\.)\S+", text)])
    own = _own_parts(speaker)
    names = list(name_spans(text, table, own, busy))
    return sorted(spans + names) if names else spans


@lru_cache(maxsize=50_000)
def _own_parts(speaker: str | None) -> frozenset[str]:
    return frozenset(w.lower() for w in split_name(speaker))


_RANK = {"email": 0, "iban": 1, "card": 2, "id_number": 3, "phone": 4, "address": 5, "name": 6}


def _best(spans: list[Span]) -> list[Span]:
    """The spans without those that overlap a better one (by kind, then length), in order; kept ones never overlap."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (_RANK[s[2]], -(s[1] - s[0]))):
        i = bisect_left(out, s)
        if (i == 0 or out[i - 1][1] <= s[0]) and (i == len(out) or s[1] <= out[i][0]):
            out.insert(i, s)
    return out


def scrub(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for a, b, kind, _ in spans:
        parts += [text[at:a], PLACEHOLDER[kind]]
        at = b
    return "".join([*parts, text[at:]])


# --- Spark ----------------------------------------------------------------------------------------


def _split_all(names: pd.Series) -> pd.Series:
    return names.map(split_name)


def _counted_parts(name_fields: DataFrame, share: float, least: int) -> tuple[DataFrame, float]:
    """``w, f, l``: in how many distinct full names a part stands first and last; and the count from which it is frequent."""
    parts = F.pandas_udf(_split_all, "array<string>")
    full = cut_lineage(
        name_fields.where(F.col("name").isNotNull())
        .groupBy("name").agg(F.count("*").alias("n"))
        .select(F.transform(parts("name"), F.lower).alias("p"))
        .where(F.size("p") >= 2)
        .groupBy("p").agg(F.lit(1).alias("one"))
    )
    floor = max(least, share * full.count())
    counted = (
        full.select(F.explode(F.array(F.struct(F.element_at("p", 1).alias("w"), F.lit(0).alias("k")), F.struct(F.element_at("p", -1).alias("w"), F.lit(1).alias("k")))).alias("x"))
        .groupBy("x.w").agg(F.sum(F.when(F.col("x.k") == 0, 1).otherwise(0)).alias("f"), F.sum(F.when(F.col("x.k") == 1, 1).otherwise(0)).alias("l"))
        .where(F.length("w") > 1)
    )
    return counted, floor


def _frequent(counted: DataFrame, floor: float, endings: frozenset[str] = frozenset(), firms: frozenset[str] = frozenset()) -> NameTable:
    ok = [(r["w"], r["f"], r["l"]) for r in counted.where((F.col("f") >= floor) | (F.col("l") >= floor)).collect()]
    first, last = frozenset(w for w, f, n in ok if f >= floor and f >= n / 4), frozenset(w for w, f, n in ok if n >= floor and n >= f / 4)
    return NameTable(first=first, last=last, endings=endings, firms=firms)


def learn_names(name_fields: DataFrame, share: float = 2e-5, least: int = 3) -> NameTable:
    """Bounded tables of the frequent name parts of a column ``name`` of structured names.

    Kept are the parts in at least ``least`` distinct full names and a ``share`` of them all, so each table has
    at most 1 / share parts, whatever the size of the corpus; the others are in ``learn_all_names``.
    """
    return _frequent(*_counted_parts(name_fields, share, least))


def learn_endings(counted: DataFrame, share: float = 0.005) -> frozenset[str]:
    """Endings of a few letters that a ``share`` of all distinct family names have: at most 3 / share of them."""
    family = counted.where("l > 0 and l >= f")
    ends = F.explode(F.array(*[F.when(F.length("w") > n, F.substring("w", -n, n)) for n in ENDING_LETTERS])).alias("e")
    common = family.select(ends).where("e is not null").groupBy("e").agg(F.count("*").alias("n"))
    return frozenset(r[0] for r in common.where(F.col("n") >= max(2.0, share * family.count())).select("e").collect())


def learn_all_names(name_fields: DataFrame, share: float = 2e-5, least: int = 3, firms: frozenset[str] = frozenset()) -> tuple[NameTable, DataFrame]:
    """The frequent name parts as a table, and all others as rows ``w, first, last``, of any number."""
    counted, floor = _counted_parts(name_fields, share, least)
    counted = cut_lineage(counted)
    first = (F.col("f") > 0) & (F.col("f") < floor) & (F.col("f") >= F.col("l") / 4)
    last = (F.col("l") > 0) & (F.col("l") < floor) & (F.col("l") >= F.col("f") / 4)
    table = _frequent(counted, floor, learn_endings(counted), firms)
    return table, counted.select("w", first.alias("first"), last.alias("last")).where("first or last")


def firm_words(addresses: DataFrame) -> frozenset[str]:
    """Words of the domains in a column ``address`` of the desk's own mail addresses (a table of fixed size)."""
    domain = F.split(F.lower(F.substring_index("address", "@", -1)), r"[^\p{L}]+")
    return frozenset(r[0] for r in addresses.select(F.explode(domain).alias("w")).where(F.length("w") > 2).distinct().collect())


FOUND = "kind string, pii_text string, score double"


def find_pii(messages: DataFrame, table: NameTable, rare: DataFrame | None = None, bucket: int = 10_000) -> DataFrame:
    """``message_id, spans ARRAY<STRUCT<start, end, kind, pii_text, score>>, scrubbed`` for every row of ``messages``.

    Needs ``message_id, text, speaker_name``; null texts give null results and empty ones empty results; copies
    of a message give equal rows; texts are searched whole.  ``rare``: name parts ``w, first, last`` beside the
    broadcast ``table``; they are joined with the distinct words of buckets of about ``bucket`` messages, so each
    bucket gets those it may need.
    """
    shared = messages.sparkSession.sparkContext.broadcast(table)
    out = "message_id string, spans array<struct<start:int,end:int,kind:string,pii_text:string,score:double>>, scrubbed string"

    def judge(batch: pd.DataFrame, t: NameTable) -> pd.DataFrame:
        spans, texts = [], []
        same: dict[tuple[str, str | None], tuple[list[dict], str]] = {}  # copies of a message lie in one batch or bucket
        for text, name in zip(batch["text"], batch["speaker_name"]):
            if text is None:
                spans.append(None), texts.append(None)
                continue
            if (done := same.get((text, name))) is None:
                found = find_spans(text, t, name)
                done = same[text, name] = [{"start": a, "end": b, "kind": k, "pii_text": text[a:b], "score": s} for a, b, k, s in found], scrub(text, found)
            spans.append(done[0]), texts.append(done[1])
        return pd.DataFrame({"message_id": batch["message_id"], "spans": spans, "scrubbed": texts})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield judge(batch, shared.value)

    needed = messages.select("message_id", "text", "speaker_name")
    if rare is None:
        return needed.mapInPandas(run, out)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(seen: dict[int, set[str]]) -> pd.DataFrame:
            low = ((b, w) for b, ws in seen.items() for w in {w.rstrip(".").lower() for w in ws})
            return pd.DataFrame(low, columns=["bucket", "w"])

        seen: dict[int, set[str]] = {}
        for batch in batches:
            for b, text in zip(batch["bucket"], batch["text"]):
                seen.setdefault(b, set()).update(_TOKEN.findall(text))
            if sum(map(len, seen.values())) > 500_000:
                yield rows(seen)
                seen = {}
        if seen:
            yield rows(seen)

    def with_rare(own: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        t = shared.value
        if len(more):
            t = NameTable(first=t.first | frozenset(more["w"][more["first"]]), last=t.last | frozenset(more["w"][more["last"]]), endings=t.endings, firms=t.firms, common=t.common)
        return judge(own, t)

    buckets = max(1, -(-messages.count() // bucket))
    dealt = needed.withColumn("bucket", F.pmod(F.xxhash64("message_id", "text"), F.lit(buckets)))
    held = dealt.where("text is not null").select("bucket", "text").mapInPandas(words, "bucket long, w string")
    more = held.join(rare, "w").groupBy("bucket", "w").agg(F.bool_or("first").alias("first"), F.bool_or("last").alias("last"))
    return dealt.groupBy("bucket").cogroup(more.groupBy("bucket")).applyInPandas(with_rare, out)
