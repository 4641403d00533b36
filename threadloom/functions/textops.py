"""Text operators as column expressions; nothing here needs Python on executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns and word lists that the results depend on ------------------------------
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = (
    r"\+?\b(?:\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b|"
    r"\+?\b(?:\d{1,3}[-.\s]?)?\d{2}[-.\s]?\d{4}[-.\s]?\d{4}\b|"
    r"\+?\b(?:44\s?|0)7\d{3}[-.\s]?\d{6}\b|"
    r"\+?\b(?:\d{1,3}[-.\s]?)?\d{5}[-.\s]?\d{5}\b"
)
STREET = (
    r"\b\d+\s+[A-Za-z0-9\s,\.]+?\s+(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Dr|Way|Court|Ct|Parkway|Pkwy|Plaza|Plz|Place|Pl|"
    r"Square|Sq|Terrace|Ter|Highway|Hwy)\b"
)
ADDRESS = rf"(?i){STREET}|(?<![#$€£])\b\d{{5}}(?:-\d{{4}})?\b"
CREDENTIAL = r"(?i)\b(password|pass|pin|passwd|credential|secret\s+key|secret|key)\b(\s*(?:is|are|of|to)?\s*[:=]\s*)([A-Za-z0-9_#$@\-]+)"
WORD = r"[\p{L}\p{N}_]+"
AUTOREPLY = ["out of office", "automatic reply", "do-not-reply", "auto-reply"]
LOW_QUALITY = ["ok", "thanks", "👍", "hello", "hi", "thank you", "k"]
SIGNATURE = [
    r"(?i)^sent\s+from\s+(?:my\s+)?(?:iphone|android|ipad|samsung|mobile|mail|phone).*$",
    r"(?i)^(?:best\s+regards|sincerely|thanks|regards|warm\s+regards|thank\s+you),?\s*$",
]
USER_INTENTS = {
    "billing_inquiry": ["billing", "charge", "invoice", "fee", "pay", "refund", "cost", "price"],
    "order_status": ["order", "track", "ship", "deliver", "status", "cancel"],
    "general_greeting": ["hi", "hello", "hey", "helpline"],
}
ASSISTANT_INTENTS = {
    "execute_action": ["refund", "update", "ship", "sent", "change", "address"],
    "request_details": ["what", "how", "provide", "verify", "password", "details"],
}
POSITIVE = ["thanks", "thank", "great", "good", "perfect", "awesome", "love", "solved", "fixed"]
NEGATIVE = ["issue", "wrong", "error", "fail", "not", "delay", "double", "broken", "damaged", "wait", "charge"]
SCRIPTS = {
    "ta - Tamil": r"\u0b80-\u0bff", "hi - Hindi": r"\u0900-\u097f", "gu - Gujarati": r"\u0a80-\u0aff", "bn - Bengali": r"\u0980-\u09ff",
    "te - Telugu": r"\u0c00-\u0c7f", "kn - Kannada": r"\u0c80-\u0cff", "ml - Malayalam": r"\u0d00-\u0d7f",
}
#: label: (least number of distinct words, words)
ROMANISED = {
    "hi - Hindi": (2, "nai rahe khelna abhi bhi toh karo kro rha raha meri mera hai kya aur aap aaj aao jao kar lekin isme usse haan nahi accha theek sahi galat samjha batao dekho chalo kaise kyun kahan kidhar kaisa kitna tumhara apna unka wala wali hoga hogi karenge karega karegi milega".split()),
    "ta - Tamil": (1, "vanakkam enaku udhavi romba nandri kandippa panrom naanga vanga ponga iruku enna epdi pannunga theriyum theriyathu sollunga vaanga poanga".split()),
    "gu - Gujarati": (1, "kem chho majama tamne aabhar bhai bahen tamaru karo karjo shu haa tyare pachhi su tamaro".split()),
    "mr - Marathi": (1, "namaskar kasa aahe tumhi mala dhanyavad kiti kaay honar aahes sagla mhanun kela keli tumcha amhi tyacha".split()),
}
ENGLISH = "the and was were have has had been would could should with from that this they them their there about which will some told asked said because before after while office unprofessional mobile games against such things didn doesn don can help need want know think please thanks thank sorry okay hello work send sent".split()
NO_LANGUAGE, ENGLISH_LABEL = "no lang found - No Language Found", "en - English"
ISSUES = [
    (["billing", "charge"], "Customer raised billing inquiry regarding incorrect/double charge."),
    (["order", "track"], "Customer requested order status or shipping details update."),
    ([], "Customer query/inquiry regarding services."),
]
RESOLUTIONS = [
    ("execute_action", "Agent executed customer request successfully."),
    ("request_details", "Agent requested details to verify identity/account."),
    (None, "Agent provided assistance."),
]
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# ---------------------------------------------------------------------------------------------------


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(x, r"^[\s\x1c-\x1f\x85\u00a0]+|[\s\x1c-\x1f\x85\u00a0]+$", "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def lines(text: Column) -> Column:
    """Split at every line terminator; one at the end opens no further line."""
    return F.split(F.regexp_replace(text, rf"(?:{LINE_END})\z", ""), LINE_END)


def any_of(text: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(text, F.lit(n))
    return out


def scrub_email(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, "[EMAIL]")


def scrub_phone(text: Column) -> Column:
    return F.regexp_replace(text, PHONE, "[PHONE]")


def scrub_address(text: Column) -> Column:
    return F.regexp_replace(text, ADDRESS, "[ADDRESS]")


def scrub_credentials(text: Column) -> Column:
    """The secret after a label; a connector that is a bare equals sign becomes a colon."""
    marked = F.regexp_replace(text, CREDENTIAL, "$1\x01$2\x02[PASSWORD]")
    return F.regexp_replace(F.regexp_replace(marked, "\x01\\s*=\\s*\x02", ": "), "[\x01\x02]", "")


def scrub_names(text: Column, names: Column) -> Column:
    """Every name of an array of at least three characters, longest first, as a whole word in any case."""
    usable = F.array_sort(F.filter(F.array_distinct(names), lambda n: F.length(n) >= 3), lambda a, b: F.length(b) - F.length(a))
    quoted = lambda n: F.concat(F.lit("(?iu)\\b\\Q"), F.replace(n, F.lit("\\E"), F.lit("")), F.lit("\\E\\b"))
    return F.aggregate(usable, text, lambda acc, n: F.regexp_replace(acc, quoted(n), F.lit("[NAME]")))


def scrub(text: Column) -> Column:
    """Addresses, numbers, places and secrets, in the order that the results depend on."""
    return scrub_credentials(scrub_address(scrub_phone(scrub_email(text))))


def is_autoreply(text: Column) -> Column:
    return any_of(F.lower(text), AUTOREPLY)


def is_low_quality(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(strip(F.lower(text)), r"^\.+|\.+$", ""), "^!+|!+$", "")
    return bare.isin(LOW_QUALITY)


def strip_signatures(text: Column) -> Column:
    """Cut at the topmost signature line below the last long line that is none.

    Lines are classed (b: barrier, m: signature, s: short or blank); the cut is the first m after the last b.
    """
    x = F.transform(lines(text), lambda line: F.struct(line.alias("raw"), strip(line).alias("bare")))
    hit = lambda b: b.rlike(SIGNATURE[0]) | b.rlike(SIGNATURE[1])
    kind = F.transform(x, lambda v: F.when(v["bare"] == "", "s").when(hit(v["bare"]), "m").when(F.length(v["bare"]) < 20, "s").otherwise("b"))
    n = F.size(kind)
    barrier = F.when(F.array_position(F.reverse(kind), "b") > 0, n - F.array_position(F.reverse(kind), "b") + 1).otherwise(0).cast("int")
    tail = F.slice(kind, barrier + 1, F.greatest(n - barrier, F.lit(0)))
    cut = F.when(F.array_position(tail, "m") > 0, barrier + F.array_position(tail, "m") - 1).otherwise(n).cast("int")
    return strip(F.array_join(F.slice(F.transform(x, lambda v: v["raw"]), F.lit(1), cut), "\n"))


def _first_label(text: Column, table: dict[str, list[str]], default: str) -> Column:
    out = None
    for label, needles in table.items():
        out = F.when(any_of(text, needles), label) if out is None else out.when(any_of(text, needles), label)
    return out.otherwise(default)


def intent(speaker: Column, text: Column) -> Column:
    low = F.lower(text)
    user = _first_label(low, USER_INTENTS, "technical_support")
    other = _first_label(low, ASSISTANT_INTENTS, "provide_information")
    return F.when(F.lower(speaker) == "user", user).otherwise(other)


def sentiment_balance(text: Column) -> Column:
    count = lambda w: F.size(F.filter(words(text), lambda x: x.isin(w)))
    return count(POSITIVE) + F.when(F.contains(text, F.lit("👍")), 1).otherwise(0) - count(NEGATIVE)


def sentiment(text: Column) -> Column:
    b = sentiment_balance(text)
    return F.when(b > 0, "positive").when(b < 0, "negative").otherwise("neutral")


def languages(text: Column) -> Column:
    """Sorted labels by script and by romanised key words; English by key words or as the ASCII default."""
    own = F.array_distinct(words(text))
    shared = lambda w: F.size(F.array_intersect(own, F.array(*[F.lit(x) for x in w])))
    found = [F.when(text.rlike(f"[{r}]"), F.lit(label)) for label, r in SCRIPTS.items()]
    found += [F.when(shared(w) >= least, F.lit(label)) for label, (least, w) in ROMANISED.items()]
    some = F.array_distinct(F.array_compact(F.array(*found)))
    english = F.when(shared(ENGLISH) > 0, F.array(F.lit(ENGLISH_LABEL))).otherwise(F.array().cast("array<string>"))
    none = F.when(text.rlike(r"[^\x00-\x7f]"), F.array(F.lit(NO_LANGUAGE))).otherwise(F.array(F.lit(ENGLISH_LABEL)))
    return F.array_sort(F.when(F.size(some) == 0, none).otherwise(F.array_union(some, english)))


FACTS = {"address": "[ADDRESS]", "email": "[EMAIL]", "phone": "[PHONE]", "credentials": "[PASSWORD]"}


def facts(text: Column) -> Column:
    """Array of (reference type, value): the first order number, then each placeholder that occurs."""
    order = F.regexp_extract(text, r"#(\d+)", 1)
    first = F.when(order != "", F.struct(F.lit("order_id").alias("kind"), F.concat(F.lit("#"), order).alias("value")))
    rest = [F.when(F.contains(text, F.lit(mark)), F.struct(F.lit(kind).alias("kind"), F.lit(mark).alias("value"))) for kind, mark in FACTS.items()]
    return F.array_compact(F.array(first, *rest))


def token_estimate(n_words: Column) -> Column:
    """Words times 1.3, halves to even."""
    return F.bround(n_words * F.lit(1.3)).cast("bigint")
