"""Matching entities across tables that share no key, each match with a confidence.

Method.  The q-grams of every attribute value are encoded as a fixed bit vector.  Pairs of close vectors are found
*exactly* by multi-index Hamming hashing over the distinct values: each vector is entered under itself and under
itself with the bits of every run of up to three successive q-grams cleared (for given names, of half of them), so two
values that one slip parts, in whatever place, always meet under the key of what both keep; phone numbers are entered
with one digit's bit cleared.  Such a key holds nearly the whole vector, so the index gives few pairs beside the close
ones.  Records that are close in enough attributes are compared field by field by the Dice coefficient; the
coefficients' levels are weighted per field and turned into confidences by a mixture model fitted by expectation
maximisation on the counts of level patterns (a table of bounded size).

Scale.  Equal records are compared once, as a class; the index runs over distinct values.  Records meet in blocks:
close e-mail, close number, close name with an equal place, code or year, or an equal name.  A block that very many
share (a switchboard) says little by itself: its records meet in the block's parts that also agree in a further
attribute, these in turn if need be (see ``blocked_pairs``).  The pairs of such a block that have no rarer agreement
are compared too, apart from those that their given names exclude whatever the model (see ``common_pairs``).
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.session import cut_lineage

# Short forms and their given names.
SHORT_FORMS = {
    "kate": "katherine", "liz": "elizabeth", "beth": "elizabeth", "mike": "michael", "tom": "thomas", "bill": "william", "bob": "robert", "rob": "robert",
    "dan": "daniel", "joe": "joseph", "andy": "andrew", "peggy": "margaret", "meg": "margaret", "maggie": "margaret", "sue": "susan", "becky": "rebecca",
    "vicky": "victoria", "trish": "patricia", "pat": "patricia", "will": "william", "steff": "stefan", "gus": "gustav", "josi": "josefine", "hanni": "hanna",
    "rafa": "rafael", "deepu": "deepak", "lakshu": "lakshmi", "tomek": "tomas", "bia": "beatriz", "giuli": "giulia", "tho": "thomas", "lena": "helene",
    "nick": "nicholas", "jim": "james", "tony": "anthony", "sam": "samuel", "alex": "alexander", "chris": "christopher", "ben": "benjamin", "ed": "edward",
    "fred": "frederick", "jack": "john", "kathy": "katherine", "katie": "katherine", "jen": "jennifer", "greg": "gregory", "matt": "matthew", "dave": "david",
}


def fold(text: str) -> str:
    """Lower case without accents; the spellings ö/oe, ß/ss and the like fall together."""
    x = text.lower().replace("ß", "ss").replace("ø", "o").replace("æ", "ae").replace("ł", "l").replace("đ", "d")
    x = "".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c))
    return re.sub(r"([aou])e", r"\1", x)


def name_parts(raw: str | None) -> tuple[str, str]:
    """(given name, family name), folded; empty where the field has none (a number, an address)."""
    if not raw:
        return "", ""
    x = re.sub(r"<[^>]*>|\S*@\S*|[\"~*_]", " ", raw)
    words = re.findall(r"[^\W\d_][^\W\d_'’-]*(?:['’-][^\W\d_]+)*\.?", x)
    if "," in x and len(words) >= 2:
        head = re.findall(r"[^\W\d_]+", x.split(",")[0])
        words = words[len(head) :] + words[: len(head)] if len(head) < len(words) else words
    words = [fold(w) for w in words]
    if not words:
        return "", ""
    if len(words) == 1:
        return "", words[0].rstrip(".")
    return words[0], words[-1]


def phone_digits(raw: str | None) -> str:
    """The last ten digits, without which country and trunk prefixes differ."""
    d = re.sub(r"\D", "", raw or "")
    return d[-10:] if len(d) >= 9 else ""


def grams(text: str, q: int = 2) -> list[str]:
    x = f"_{text}_"
    return [x[i : i + q] for i in range(len(x) - q + 1)]


@lru_cache(maxsize=100_000)
def _bit(gram: str, bits: int = 256) -> int:
    return 1 << (zlib.crc32(gram.encode()) * 2654435761 >> 7) % bits


def bit_vector(parts: list[str]) -> int:
    v = 0
    for p in parts:
        v |= _bit(p)
    return v


def email_parts(local: str) -> tuple[str, str]:
    """(digits, the rest) of a local part."""
    return re.sub(r"\D", "", local), re.sub(r"\d", "", local)


@lru_cache(maxsize=50_000)
def email_vector(local: str) -> int:
    return bit_vector(grams(fold(local)))


def phone_marks(digits: str) -> list[int]:
    """Positional digits: one bit per place and digit."""
    return [1 << (10 * i + int(c)) for i, c in enumerate(digits)]


def cleared(marks: list[int], longest: int, shortest: int = 0) -> set[int]:
    """The vector of ``marks`` with each run of ``shortest`` to ``longest`` successive marks cleared; never the empty one."""
    n = len(marks)
    before, after = [0], [0]
    for i in range(n):
        before.append(before[-1] | marks[i])
        after.append(after[-1] | marks[n - 1 - i])
    out = {before[i] | after[n - i - k] for k in range(shortest, longest + 1) for i in range(n - k + 1)}
    out.discard(0)
    return out


def index_keys(kind: str, value: str) -> set[int]:
    """Keys under which a value is entered: ``email`` (a local part), ``phone``, ``given`` or ``family``."""
    guard, more = kind, set()
    if kind == "phone":
        vectors = cleared(phone_marks(value), 1, 1)
    elif kind == "email":  # other numbers are other people, so the number is part of every key
        digits, rest = email_parts(value)
        guard += digits
        vectors = cleared([_bit(g) for g in grams(fold(rest))], 3)
    else:
        x = value.rstrip(".")
        if len(x) < 2:  # initials meet by their letter
            return set()
        vectors = set()
        for form in {x, _LONG.get(x, x)} if kind == "given" else {x}:
            marks = [_bit(g) for g in grams(form)]
            vectors |= cleared(marks, max(3, min(6, len(marks) // 2)) if kind == "given" else 3)
        if kind == "given":
            more = {"=" + _LONG.get(x, x)}
    tags = {f"{guard}|{v:x}" for v in vectors} | {f"{guard}|{m}" for m in more}
    return {int.from_bytes(blake2b(t.encode(), digest_size=8).digest(), "little", signed=True) for t in tags}


def is_close(kind: str, x: str, y: str) -> bool:
    """Whether the scorer takes the two values for more than different."""
    if kind == "phone":
        return sum(a == b for a, b in zip(x, y)) >= 9 if len(x) == len(y) == 10 else x == y
    if kind == "email":
        return email_level(x, y) >= LEVELS["email"][0]
    return given_level(x, y) >= LEVELS["given"][0] if kind == "given" else family_level(x, y) >= LEVELS["family"][1]


def value_index(values: DataFrame) -> DataFrame:
    """``kind, key, value, n``: the index of distinct ``kind, value`` with the number ``n`` of records that bear each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(kind, k, value, n) for kind, value, n in batch[["kind", "value", "n"]].itertuples(index=False) for k in index_keys(kind, value)]
            yield pd.DataFrame(rows, columns=["kind", "key", "value", "n"])

    return values.mapInPandas(run, "kind string, key long, value string, n long")


def close_values(values: DataFrame) -> DataFrame:
    """All pairs ``kind, value, other`` that are close (``is_close``) and that a run tells apart, ``other`` the more frequent.

    One value with all its rarer likes would grow with the corpus (the slips of a common name); a value's more
    frequent likes are few, and two values are close through exactly one of these directions.
    """

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[is_close(k, x, y) for k, x, y in zip(batch["kind"], batch["value"], batch["other"])]]

    # The keys cost more than their bytes show, so the values are dealt to a fixed number of tasks.
    index = cut_lineage(value_index(values.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    a = index.select("kind", "key", "value", F.struct("n", "value").alias("rank"))
    b = index.select("kind", "key", F.col("value").alias("other"), F.struct("n", "value").alias("higher"))
    met = a.join(b, ["kind", "key"]).where("higher > rank").select("kind", "value", "other").distinct()
    return met.mapInPandas(judged, "kind string, value string, other string")


PREPARED = "side int, id long, given string, family string, email string, phone string, town string, postcode string, year string"


def prepare(table: DataFrame, side: int, id_col: str, name: Column) -> DataFrame:
    """Normalised attributes; null, blank and useless values become empty strings; a tag in an address is dropped."""
    rows = table.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), name.alias("name"), "email", "phone", "town", "postcode", F.col("birth_year").cast("string").alias("year")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [name_parts(n) for n in batch["name"]]
            mails = [re.sub(r"\+[^@]*@", "@", (e or "").strip().lower()) for e in batch["email"]]
            yield pd.DataFrame(
                {
                    "side": side, "id": batch["id"], "given": [p[0] for p in parts], "family": [p[1] for p in parts],
                    "email": [e if "@" in e else "" for e in mails], "phone": [phone_digits(p) for p in batch["phone"]],
                    "town": [fold(re.sub(r"[^\w]+", " ", t or "").strip()) for t in batch["town"]],
                    "postcode": [re.sub(r"\W", "", p or "") for p in batch["postcode"]], "year": [y or "" for y in batch["year"]],
                }
            )

    return rows.dropDuplicates(["id"]).mapInPandas(run, PREPARED)


def _tagged(tag: str, values: Column) -> Column:
    return F.transform(values, lambda x: F.concat(F.lit(tag), x))


def evidence(classes: DataFrame) -> DataFrame:
    """``side, cls, e, p, g, f, s, n``: arrays of what a class can agree in; of two close values one is in both arrays.

    An initial meets the names it may stand for by its letter ("<": it stands on the left, ">": on the right).
    """
    local = F.substring_index("email", "@", 1)
    named = [("email", local), ("phone", F.col("phone")), ("given", F.col("given")), ("family", F.col("family"))]
    values = classes.select("side", "cls", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in named])).alias("x"))
    values = values.select("side", "cls", "x.kind", "x.value").where("value <> ''")
    near = close_values(values.groupBy("kind", "value").agg(F.count("*").alias("n")))
    near = near.groupBy("kind", "value").agg(F.collect_list("other").alias("near"))  # a value's more frequent likes, few
    met = values.join(near, ["kind", "value"]).groupBy("side", "cls")
    met = met.agg(*[F.first(F.when(F.col("kind") == k, F.col("near")), True).alias(f"near_{k}") for k, _ in named])
    none = F.array().cast("array<string>")
    left = F.col("side") == 0
    cols = []
    for k, v in named:
        own = F.when(v != "", F.concat(F.array(v), F.coalesce(f"near_{k}", none))).otherwise(none)
        if k in ("given", "family"):
            letter, initial = F.substring(k, 1, 1), F.length(F.rtrim(v, F.lit("."))) == 1
            here = F.concat(F.when(left, ">").otherwise("<"), letter)
            there = F.concat(F.when(left, "<").otherwise(">"), letter)
            own = F.concat(own, F.array_compact(F.array(F.when(v != "", here), F.when((v != "") & initial, there))))
        cols.append(_tagged(k[0], own).alias(k[0]))
    known = lambda x: F.col(x) != ""
    rest = F.array_compact(F.array(*[F.when(known(c), F.concat(F.lit(t), F.col(c))) for c, t in (("postcode", "q"), ("year", "y"), ("town", "z"))]))
    name = F.array_compact(F.array(F.when(known("given") & known("family"), F.concat_ws("|", F.lit("n"), "given", "family"))))
    return classes.join(met, ["side", "cls"], "left").select("side", "cls", *cols, rest.alias("s"), name.alias("n"))


def first_blocks(proof: DataFrame) -> DataFrame:
    """``side, cls, block``: an e-mail, a number, a name with a place, code or year, an equal name."""
    each = lambda c: F.transform(c, lambda x: F.array(x))
    both = F.flatten(F.transform("g", lambda x: F.transform("f", lambda y: F.array(x, y))))
    supported = F.flatten(F.transform(both, lambda z: F.transform("s", lambda q: F.concat(z, F.array(q)))))
    return proof.select("side", "cls", F.explode(F.concat(each("e"), each("p"), supported, each("n"))).alias("block"))


def blocked_pairs(proof: DataFrame, shared: int = 40) -> DataFrame:
    """Distinct pairs ``a, b, vague`` (classes of side 0 and 1) that agree in enough evidence (see ``evidence``).

    Blocks: an e-mail, a number, a name with a place, code or year, an equal name.  In a block of at most ``shared``
    classes on either side all pairs meet.  In a larger one those meet that agree in one more kind of evidence, in a
    block of their own, which is treated likewise; the kinds are finite and classes differ, so this ends.  The pairs
    whose every agreement more than ``shared`` others have alike are those of ``common_pairs``.

    ``vague``: all they have is a name, equal or close, beside an address or number that very many share.
    """
    proof = cut_lineage(proof)
    key = F.xxhash64("block").alias("key")
    blocks = first_blocks(proof)
    vague = (F.size("block") > 1) & F.forall("block", lambda x: x.rlike("^[epgf]")) & ~F.element_at("block", 1).rlike("^g") & ~F.element_at("block", 2).rlike("^p")
    found = None
    while True:
        rows = cut_lineage(blocks.select("side", "cls", key, vague.alias("vague")))
        size = rows.groupBy("key").agg(F.count(F.when(F.col("side") == 0, 1)).alias("n0"), F.count(F.when(F.col("side") == 1, 1)).alias("n1")).where("n0 > 0 and n1 > 0")
        size = cut_lineage(size)
        small = rows.join(size.where((F.col("n0") <= shared) & (F.col("n1") <= shared)).select("key"), "key", "left_semi")
        pairs = small.where("side = 0").select("key", F.col("cls").alias("a"), "vague").join(small.where("side = 1").select("key", F.col("cls").alias("b")), "key")
        pairs = pairs.select("a", "b", "vague")
        found = pairs if found is None else found.unionByName(pairs)
        hot = size.where((F.col("n0") > shared) | (F.col("n1") > shared)).select("key")
        if hot.isEmpty():
            return found.groupBy("a", "b").agg(F.bool_and("vague").alias("vague"))
        large = blocks.where(~F.element_at("block", 1).startswith("n")).withColumn("key", key).join(hot, "key", "left_semi").select("side", "cls", "block")
        # Kinds are added in one order, so that a set of agreements is reached once.
        kinds = F.lit("epgfqyz")
        rank = lambda x: F.call_function("instr", kinds, F.substring(x, 1, 1))
        more = proof.select("side", "cls", F.concat("p", "g", "f", "s").alias("more"))
        longer = large.join(more, ["side", "cls"]).select("side", "cls", "block", F.explode("more").alias("x")).where(rank(F.col("x")) > rank(F.element_at("block", -1)))
        blocks = longer.select("side", "cls", F.concat("block", F.array("x")).alias("block"))


def _crossed(left: DataFrame, right: DataFrame, on: list[str], own: tuple[str, str], sizes: tuple[str, str], side: int = 256) -> DataFrame:
    """The join of ``left`` and ``right``, every group dealt in cells of about ``side`` times ``side`` rows, so that no task has a large one whole.

    ``own``: the column of either by which its rows are dealt; ``sizes``: columns of both, the group's rows in either.
    """
    parts = [F.ceil(F.col(n) / side).cast("long") for n in sizes]
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), parts[k] - 1))
    dealt = lambda k: F.pmod(F.xxhash64(own[k]), parts[k])
    a = left.withColumn("i", dealt(0)).withColumn("j", every(1)).drop(*sizes)
    b = right.withColumn("j", dealt(1)).withColumn("i", every(0)).drop(*sizes)
    return a.join(b, [*on, "i", "j"]).drop("i", "j")


def common_pairs(proof: DataFrame, classes: DataFrame, found: DataFrame, keep: float = 0.5, shared: int = 40) -> DataFrame | None:
    """``a, b, vague``: the pairs that meet in a block of more than ``shared`` classes and are not in ``found``; none: no such block.

    All of them, or where ``keep`` is above ``UNLIKE`` all but those whose given names differ while their addresses
    are not equal: ``adjusted`` gives these ``UNLIKE`` at most, whatever the model.  They are excluded by the block's
    distinct given names, before its classes are paired.
    """
    rows = cut_lineage(first_blocks(proof).select("side", "cls", F.xxhash64("block").alias("key")).distinct())
    of = lambda k: F.count(F.when(F.col("side") == k, 1)).alias(f"n{k}")
    size = cut_lineage(rows.groupBy("key").agg(of(0), of(1)).where((F.col("n0") > 0) & (F.col("n1") > 0) & ((F.col("n0") > shared) | (F.col("n1") > shared))))
    if size.isEmpty():
        return None
    hot = cut_lineage(rows.join(size.select("key"), "key", "left_semi").join(classes.select("side", "cls", "given", "email"), ["side", "cls"]))

    def like(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[keep <= UNLIKE or not 0 <= given_level(x, y) < LEVELS["given"][0] for x, y in zip(batch["g0"], batch["g1"])]]

    names = hot.groupBy("key", "side", "given").agg(F.count("*").alias("m")).join(size, "key")
    name = lambda k: names.where(F.col("side") == k).select("key", F.col("given").alias(f"g{k}"), F.col("m").alias(f"m{k}"), "n0", "n1")
    alike = _crossed(name(0), name(1), ["key"], ("g0", "g1"), ("n0", "n1"))
    alike = cut_lineage(alike.select("key", "g0", "g1", "m0", "m1").mapInPandas(like, "key long, g0 string, g1 string, m0 long, m1 long"))
    bears = lambda k, c: hot.where(F.col("side") == k).select("key", F.col("given").alias(f"g{k}"), F.col("cls").alias(c)).join(alike, ["key", f"g{k}"])
    met = _crossed(bears(0, "a"), bears(1, "b"), ["key", "g0", "g1"], ("a", "b"), ("m0", "m1")).select("a", "b")
    mails = hot.where("email <> ''").groupBy("key", "email").agg(of(0), of(1)).where("n0 > 0 and n1 > 0")
    mail = lambda k, c: hot.where(F.col("side") == k).select("key", "email", F.col("cls").alias(c)).join(mails, ["key", "email"])
    met = met.unionByName(_crossed(mail(0, "a"), mail(1, "b"), ["key", "email"], ("a", "b"), ("n0", "n1")).select("a", "b")).distinct()
    met = met.join(found.select("a", "b"), ["a", "b"], "left_anti")
    known = lambda k, c: proof.where(F.col("side") == k).select(F.col("cls").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in "eps"])
    e, p, s = (F.arrays_overlap(f"{x}_a", f"{x}_b") for x in "eps")
    return met.join(known(0, "a"), "a").join(known(1, "b"), "b").select("a", "b", ((e != p) & ~s).alias("vague"))


def dice(a: int, b: int) -> float:
    n = a.bit_count() + b.bit_count()
    return 2 * (a & b).bit_count() / n if n else 0.0


_LONG = {fold(k): fold(v) for k, v in SHORT_FORMS.items()}


def given_level(a: str, b: str) -> float:
    """Agreement of given names: 1 equal or short form, 0.9 initial, else Dice."""
    if not a or not b:
        return -1.0
    x, y = a.rstrip("."), b.rstrip(".")
    if x == y or _LONG.get(x, x) == _LONG.get(y, y):
        return 1.0
    if len(x) == 1 or len(y) == 1:
        return 0.9 if x[0] == y[0] else 0.0
    if len(x) > 2 and len(y) > 2 and one_edit(x, y):
        return 0.9
    return dice(bit_vector(grams(_LONG.get(x, x))), bit_vector(grams(_LONG.get(y, y))))


def family_level(a: str, b: str) -> float:
    if not a or not b:
        return -1.0
    x, y = a.rstrip("."), b.rstrip(".")
    if len(x) == 1 or len(y) == 1:
        return 0.9 if x[0] == y[0] else 0.0
    if x == y:
        return 1.0
    # Family names share long endings, so beyond one slip likeness says little.
    return 0.9 if one_edit(x, y) else 0.6 * dice(bit_vector(grams(x)), bit_vector(grams(y)))


def email_level(x: str, y: str) -> float:
    """Dice of the local parts, which say little when their numbers differ: those tell namesakes apart."""
    a, b = x.split("@")[0], y.split("@")[0]
    if a == b:
        return 0.998
    if re.sub(r"\D", "", a) != re.sub(r"\D", "", b):
        return 0.0
    return min(0.95, dice(email_vector(a), email_vector(b)) + (0.2 if one_edit(a, b) else 0.0))


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or exchange of neighbours turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


#: The most confidence with different given names and without an equal address.
UNLIKE = 0.1
FIELDS = ("given", "family", "email", "phone", "town", "postcode", "year")
#: Dice coefficients at which a level begins; level 0 is disagreement, the highest is equality, -1 a missing value.
LEVELS = {"given": (0.6, 0.85, 0.999), "family": (0.55, 0.85, 0.999), "email": (0.8, 0.999), "phone": (0.85, 0.999), "town": (0.55, 0.999), "postcode": (0.7, 0.999), "year": (0.999,)}


def compare(a: tuple, b: tuple) -> tuple[int, ...]:
    """Level of each of FIELDS for two prepared records."""
    out = []
    for f, x, y in zip(FIELDS, a, b):
        if f == "given":
            s = given_level(x, y)
        elif f == "family":
            s = family_level(x, y)
        elif not x or not y:
            s = -1.0
        elif x == y:
            s = 1.0
        elif f == "email":
            s = email_level(x, y)
        elif f == "phone":
            s = sum(p == q for p, q in zip(x, y)) / max(len(x), len(y))
        elif f == "year":
            s = 0.0
        elif f == "postcode":
            s = sum(p == q for p, q in zip(x, y)) / max(len(x), len(y))
        else:
            s = dice(bit_vector(grams(x)), bit_vector(grams(y)))
        out.append(-1 if s < 0 else sum(s >= t for t in LEVELS[f]))
    return tuple(out)


# Starting probabilities of the levels among matches and among candidates that are none (missing values carry no weight).
START_M = {"given": (0.02, 0.05, 0.13, 0.8), "family": (0.01, 0.04, 0.15, 0.8), "email": (0.1, 0.1, 0.8), "phone": (0.12, 0.04, 0.84), "town": (0.1, 0.25, 0.65), "postcode": (0.12, 0.08, 0.8), "year": (0.06, 0.94)}
START_U = {"given": (0.85, 0.08, 0.03, 0.04), "family": (0.85, 0.1, 0.03, 0.02), "email": (0.9, 0.09, 0.01), "phone": (0.9, 0.08, 0.02), "town": (0.9, 0.03, 0.07), "postcode": (0.93, 0.05, 0.02), "year": (0.95, 0.05)}


class Calibration:
    """Field weights (log2 ratios per level) and the confidence of a level pattern."""

    def __init__(self, m: dict, u: dict, prior: float) -> None:
        self.m, self.u, self.prior = m, u, prior

    def confidence(self, levels: tuple[int, ...]) -> float:
        s = math.log(self.prior / (1 - self.prior))
        for f, x in zip(FIELDS, levels):
            if x >= 0:
                s += math.log(self.m[f][x] / self.u[f][x])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, s))))


def calibrate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 15, weight: float = 200.0) -> Calibration:
    """Expectation maximisation over pattern counts, held near the starting values by pseudo-counts of ``weight``."""
    total = sum(n for _, n in patterns) or 1
    model = Calibration(START_M, START_U, 0.1)
    for _ in range(rounds):
        m = {f: [p * weight for p in START_M[f]] for f in FIELDS}
        u = {f: [p * weight for p in START_U[f]] for f in FIELDS}
        hits = 0.1 * weight
        for levels, n in patterns:
            c = model.confidence(levels)
            hits += n * c
            for f, x in zip(FIELDS, levels):
                if x >= 0:
                    m[f][x] += n * c
                    u[f][x] += n * (1 - c)
        norm = lambda t: {f: [x / sum(v) for x in v] for f, v in t.items()}
        model = Calibration(norm(m), norm(u), min(0.9, max(1e-4, hits / (total + weight))))
    return model


def match(profiles: DataFrame, contacts: DataFrame, keep: float = 0.5) -> DataFrame:
    """``a, b, confidence``: pairs of the two prepared tables (sides 0 and 1) that are one entity.

    Records without any usable attribute match nothing; repeated ids count once; ties are kept whole.
    """
    fields = list(FIELDS)
    people = cut_lineage(profiles.unionByName(contacts).withColumn("cls", F.unhex(F.md5(F.concat_ws("\x01", *fields)))))
    classes = people.groupBy("side", "cls").agg(*[F.first(f).alias(f) for f in fields])
    proof = cut_lineage(evidence(classes))
    found = cut_lineage(blocked_pairs(proof))
    common = common_pairs(proof, classes, found, keep)
    pairs = found.withColumn("rare", F.lit(True))
    if common is not None:
        pairs = pairs.unionByName(common.withColumn("rare", F.lit(False)))
    left = classes.where("side = 0").select(F.col("cls").alias("a"), *[F.col(f).alias(f"{f}_a") for f in fields])
    right = classes.where("side = 1").select(F.col("cls").alias("b"), *[F.col(f).alias(f"{f}_b") for f in fields])
    both = pairs.join(left, "a").join(right, "b")

    def levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            xa = batch[[f"{f}_a" for f in fields]].itertuples(index=False, name=None)
            xb = batch[[f"{f}_b" for f in fields]].itertuples(index=False, name=None)
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "vague": batch["vague"], "rare": batch["rare"], "levels": [list(compare(p, q)) for p, q in zip(xa, xb)]})

    compared = cut_lineage(both.mapInPandas(levels, "a binary, b binary, vague boolean, rare boolean, levels array<int>"))
    # At most one row per pattern of levels: the product of the fields' level counts bounds it.  The model is fitted on
    # the pairs with a rare agreement; those of a switchboard would teach it that equal numbers say nothing anywhere.
    patterns = [(tuple(r[0]), r[1]) for r in compared.groupBy("levels").agg(F.count(F.when(F.col("rare"), 1)).alias("n")).collect()]
    model = calibrate(patterns)
    table = [(list(p), float(adjusted(model, p)), *standing(p)) for p, _ in patterns]
    spark = people.sparkSession
    scores = spark.createDataFrame(table or [([0], 0.0, False, False)], "levels array<int>, confidence double, firm boolean, loose boolean")
    kept = compared.join(F.broadcast(scores), "levels").where(F.col("confidence") >= keep)
    # A record that has found its person: its loose pairs are namesakes, and where many share a number, so are close names.
    equal = (F.col("levels")[0] == 3) & (F.col("levels")[1] == 3)
    kept = kept.withColumn("vague", F.col("vague") & ~equal)
    of = lambda c: kept.where("firm and not vague").groupBy(c).agg(F.bool_or(equal).alias(f"named_{c}"))
    kept = kept.join(of("a"), "a", "left").join(of("b"), "b", "left")
    kept = kept.where("not (loose and named_b is not null) and not (vague and (coalesce(named_a, false) or coalesce(named_b, false)))")
    kept = kept.select(F.col("a").alias("cls_a"), F.col("b").alias("cls_b"), "confidence")
    own = lambda side, c: people.where(F.col("side") == side).select(F.col("cls").alias(f"cls_{c}"), F.col("id").alias(c))
    return kept.join(own(0, "a"), "cls_a").join(own(1, "b"), "cls_b").select("a", "b", "confidence")


def reliability(profiles: DataFrame, contacts: DataFrame, edges: tuple[float, ...] = (0.5, 0.7, 0.9, 0.97, 0.99)) -> DataFrame:
    """The confidences against a field held out: ``at_least, n_pairs, confidence, agreeing``.

    Records are matched without their e-mail; of the pairs in which both sides have one, by confidence from
    ``at_least`` on, the mean confidence and the share whose addresses agree in their numbers and nearly in the rest.
    """
    blind = lambda x: x.withColumn("email", F.lit(""))
    found = match(blind(profiles), blind(contacts), keep=0.0)
    mail = lambda x, c: x.where("email <> ''").select(F.col("id").alias(c), F.substring_index("email", "@", 1).alias(f"mail_{c}"))
    pairs = found.join(mail(profiles, "a"), "a").join(mail(contacts, "b"), "b")
    same = F.pandas_udf(lambda x, y: pd.Series([email_level(p, q) >= LEVELS["email"][0] for p, q in zip(x, y)]), "boolean")
    floor = F.greatest(*[F.when(F.col("confidence") >= e, e).otherwise(0.0) for e in edges])
    return pairs.groupBy(floor.alias("at_least")).agg(
        F.count("*").alias("n_pairs"), F.avg("confidence").alias("confidence"), F.avg(same("mail_a", "mail_b").cast("int")).alias("agreeing")
    )


def standing(levels: tuple[int, ...]) -> tuple[bool, bool]:
    """Whether a pair agrees in address or number (firm), and whether in nothing but name and town (loose).

    A record with a firm pair has found its person; its loose pairs are namesakes.
    """
    _, _, email, phone, _, postcode, year = levels
    firm = email == 2 or phone == 2
    return firm, not firm and postcode < 2 and year < 1


def adjusted(model: Calibration, levels: tuple[int, ...]) -> float:
    """The model's confidence, with the dependence between fields that it does not see.

    People of a household share family name, town, postcode and often the phone, so those together never outweigh
    different given names.
    """
    given, family, email, phone, town, postcode, year = levels
    c = model.confidence(levels)
    if given == 0 and email < 2:
        return min(c, UNLIKE)
    if family == 0 and email < 2 and phone < 2:
        return min(c, 0.1)
    if email < 1 and phone < 1 and (email == 0 or phone == 0) and max(town, postcode, year) <= 0:
        return min(c, 0.4)  # a name shared and another address or number: as likely two people
    return c
