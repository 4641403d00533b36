"""Quoted history and signatures in e-mails: only the lines newly written by the sender.

Method.  The plain (unquoted) words of a thread's mails go into one generalised suffix automaton per thread.
A mail's words are run through it, whatever its line wrapping; maximal matches with earlier mails that are
long enough are inherited.  Quote marks, lead-in lines and header blocks delimit quoted zones, in which text is
inherited even if its source never arrived.  From what remains, recurring sender endings are stripped: a closing
formula or separator with the name and contact lines under it, and footers learnt from the corpus as lines that
recur over senders and practically only in last paragraphs.

Skew.  A thread of more than ``block`` mails is split into blocks by a hash of the message id; each block gets,
beside its own mails, those mails of the thread that first hold one of its runs of ``least`` words, and adds each at
its place in the order of arrival.  So every match is found as in one block, and no task need get a whole hot thread;
the other threads are read whole, as they are without hot ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Set
from hashlib import blake2b

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import cut_lineage, whole_groups

# Closing formulas, compared in lower case without the comma or stop at their end.
CLOSINGS = frozenset(
    """best regards|kind regards|warm regards|regards|best wishes|many thanks and best wishes|many thanks|thanks|thank you|thanks a lot|sincerely|yours sincerely|yours faithfully|yours truly|cheers|best|br|kr|all the best|take care
    mit freundlichen grüßen|mit freundlichen grüssen|mit freundlichem gruß|freundliche grüße|viele grüße|beste grüße|liebe grüße|herzliche grüße|schöne grüße|mfg|lg|vg|gruß|grüße|vielen dank|danke
    cordialement|bien cordialement|bien à vous|salutations distinguées|sincères salutations|meilleures salutations|amicalement|merci|merci d'avance|bonne journée
    atentamente|un saludo|saludos|saludos cordiales|un cordial saludo|cordialmente|gracias|muchas gracias|muy atentamente
    cordiali saluti|distinti saluti|un saluto|saluti|grazie|grazie mille|cordialità|un caro saluto
    atenciosamente|cumprimentos|com os melhores cumprimentos|melhores cumprimentos|abraços|um abraço|obrigado|obrigada|grato|grata
    भवदीय|सादर|धन्यवाद|आपका|आपकी|शुभकामनाओं सहित|bhavdiya|saadar|sadar|dhanyavaad|dhanyavad|aapka|shukriya
    அன்புடன்|நன்றி|இப்படிக்கு|மிக்க நன்றி|met vriendelijke groet|groeten|groetjes|hartelijke groet""".replace("\n", "|").split("|")
)
CLOSINGS = frozenset(x.strip() for x in CLOSINGS)

_MARK = re.compile(r"^\s*[>|]")
_RULE = re.compile(r"^[\s\-_=*~#.·•–—+]{2,}$")
_LABEL = (
    r"(?:from|von|de|da|van|od|sent|gesendet|envoyé|enviado|inviato|inviata|date|datum|fecha|data|to|an|à|para|a|cc|"
    r"subject|betreff|objet|asunto|oggetto|assunto|onderwerp|verzonden|aan|प्रेषक|भेजा गया|अनुप्रेषक)\s?:"
)
_HEADER = re.compile(rf"^\s*[*]?{_LABEL}", re.I)
_SENDER_HEADER = re.compile(r"^\s*[*]?(?:from|von|de|da|van|od|प्रेषक|अनुप्रेषक)\s?:.*(?:@|<|\[)", re.I)
_ORIGINAL = re.compile(r"^\s*-{3,}\s*\S.*\S\s*-{3,}\s*$")
_WORD = re.compile(r"[\w\u0300-\u036f\u0900-\u0dff]+", re.U)  # with the vowel signs of Indic scripts
_DIGITS = re.compile(r"\d+")
_POSTSCRIPT = re.compile(r"^\s*p\.?\s?s\.?\s*[:.\s]", re.I)
_DEVICE = re.compile(r"^(?:sent from|get the|gesendet (?:von|mit)|von meinem .* gesendet|envoyé (?:de|depuis)|enviado (?:desde|do|de)|inviato (?:da|dal)|मेरे .* से भेजा)\b.{0,60}$", re.I)

PLAIN, BLANK, QUOTED, LEAD = "p", ".", "q", "l"


def zones(lines: list[str]) -> list[str]:
    """A class for each line; after the header block of an unmarked quotation all lines are quoted."""
    n = len(lines)
    kinds = [QUOTED if _MARK.match(x) else PLAIN if x.strip() else BLANK for x in lines]
    for i, line in enumerate(lines):
        if kinds[i] != PLAIN:
            continue
        j = i + 1 if (_ORIGINAL.match(line) or _RULE.match(line)) else i
        while j < n and j > i and not lines[j].strip():
            j += 1
        if j + 1 < n and _SENDER_HEADER.match(lines[j]) and _HEADER.match(lines[j + 1]):
            kinds[i:] = [BLANK if k == BLANK else QUOTED for k in kinds[i:]]
            break
    for i in range(n):  # a lead-in stands directly above its quotation and may be wrapped
        if kinds[i] != QUOTED or not _MARK.match(lines[i]):
            continue
        j = i - 1
        while j >= 0 and kinds[j] == BLANK and i - j <= 2:
            j -= 1
        if j < 0 or kinds[j] != PLAIN or not lines[j].rstrip().endswith(":"):
            continue
        text = lines[j]
        if not (any(c.isdigit() for c in text) or "@" in text):
            continue
        kinds[j] = LEAD
        if (text.lstrip().startswith("<") or not any(c.isdigit() for c in text.split("<")[0])) and j > 0 and kinds[j - 1] == PLAIN:
            kinds[j - 1] = LEAD
    return kinds


def segments(kinds: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of plain and blank lines between quoted ones."""
    start = None
    for i, k in enumerate([*kinds, QUOTED]):
        inside = k in (PLAIN, BLANK)
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            yield start, i
            start = None


def masked(line: str) -> str:
    return _DIGITS.sub("9", " ".join(line.split()))


def line_key(line: str) -> int:
    """Key of a line of any length, numbers and blanks aside."""
    return int.from_bytes(blake2b(masked(line).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def is_closing(line: str) -> bool:
    return len(line) <= 60 and line.strip().rstrip(",.!;").strip().lower() in CLOSINGS


def _ending_like(line: str) -> bool:
    """A name, title, contact, address or link line, not a sentence."""
    x = line.strip()
    return len(x) <= 80 and len(x.split()) <= 9 and not x.endswith((".", "!", "?", "।", ":"))


def signature_start(lines: list[str], kinds: list[str], a: int, b: int, footers: Set[int], own: frozenset[str]) -> int:
    """Where the ending of the plain segment begins (``b``: it has none)."""
    end = b
    for i in range(b - 1, a, -1):  # a postscript follows the ending
        if _POSTSCRIPT.match(lines[i]) and not lines[i - 1].strip():
            end = i
            break
    # Footers and separators from the bottom up.
    while end > a:
        x = lines[end - 1]
        if not x.strip() or _RULE.match(x) or (footers and line_key(x) in footers) or (_DEVICE.match(x.strip()) and _ending_like(x)):
            end -= 1
        else:
            break
    cut = end
    # The last closing formula or separator with nothing but ending lines under it.
    for i in range(end - 1, a - 1, -1):
        x = lines[i]
        if not x.strip():
            continue
        if is_closing(x):
            before = next((lines[j].strip() for j in range(i - 1, a - 1, -1) if lines[j].strip()), "")
            if i == a or not lines[i - 1].strip() or kinds[i - 1] != PLAIN or before.endswith((".", "!", "?", ")", "।", "…", ",", ":")) or not before or not _continues(before):
                cut = i
            break
        if _RULE.match(x):
            cut = i
            break
        if not _ending_like(x):
            break
    if cut == end:  # a bare name, with contact lines at most, as last paragraph
        p = end
        while p > a and lines[p - 1].strip():
            p -= 1
        block = lines[p:end]
        first = _words(block[0]) if block else []
        if p > a and block and len(block) <= 6 and first and len(first) <= 4 and all(w in own for w in first) and all(map(_ending_like, block)):
            cut = p
    while cut > a and (not lines[cut - 1].strip() or _RULE.match(lines[cut - 1]) or (footers and line_key(lines[cut - 1]) in footers)):
        cut -= 1
    return cut


def _continues(before: str) -> bool:
    """Whether a line looks cut off by wrapping, so that the next belongs to the same sentence."""
    return len(before) > 45


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class SuffixAutomaton:
    """Generalised suffix automaton over word ids; texts are added one after the other."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                if length[q] == length[last] + 1:
                    last = q
                else:
                    last = self._clone(last, w, q)
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][w]
                link[cur] = q if length[p] + 1 == length[q] else self._clone(p, w, q)
            last = cur

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        link[q] = c
        return c

    def cover(self, words: list[int], least: int) -> bytearray:
        """1 for each word inside a match of at least ``least`` words."""
        nxt, link, length = self.next, self.link, self.length
        out = bytearray(len(words))
        state, m, done = 0, 0, 0
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                m = length[state]
            state = nxt[state].get(w, 0)
            m = m + 1 if state else 0
            if m >= least:
                a = max(done, i + 1 - m)
                out[a : i + 1] = b"\x01" * (i + 1 - a)
                done = i + 1
        return out


def own_lines(text: str, sender: str | None, footers: Set[int]) -> tuple[list[str], list[int]]:
    """The text's lines, and the numbers from 0 of those that are neither marked as quoted nor an ending."""
    lines = text.replace("\r", "").split("\n")
    kinds = zones(lines)
    own = frozenset(_words(re.sub(r"<[^>]*>", " ", sender or "")))
    keep: list[int] = []
    for a, b in segments(kinds):
        cut = signature_start(lines, kinds, a, b, footers, own)
        rest = range(cut, b)
        keep += [i for i in range(a, cut) if kinds[i] == PLAIN and not _RULE.match(lines[i])]
        keep += [i for i in _postscript(lines, rest)]
    return lines, keep


def own_words(text: str, sender: str | None, footers: Set[int]) -> list[str]:
    lines, keep = own_lines(text, sender, footers)
    return [w for i in keep for w in _words(lines[i])]


def new_lines(
    mails: list[tuple[str, str, str | None]], sources: list[tuple[int, list[str]]], footers: Set[int], least: int
) -> Iterator[tuple[str, list[int], list[str]]]:
    """For one block of a thread: (id, numbers from 1 of the new non-blank lines, those lines).

    ``mails``: (id, text, sender's name) in order of arrival; ``sources``: words of mails of other blocks in order of
    arrival, each with the number of the block's mails that came before it.
    """
    ids: dict[str, int] = {}
    number = lambda words: [ids.setdefault(w, len(ids)) for w in words]
    automaton = SuffixAutomaton()
    single = len(mails) == 1 and not sources
    at = 0
    for n, (mid, text, sender) in enumerate(mails):
        while at < len(sources) and sources[at][0] <= n:
            automaton.add(number(sources[at][1]))
            at += 1
        lines, keep = own_lines(text, sender, footers)
        if not single and keep:
            where: list[int] = []
            words: list[str] = []
            for i in keep:
                ws = _words(lines[i])
                words += ws
                where += [i] * len(ws)
            coded = number(words)
            covered = automaton.cover(coded, least)
            if any(covered):
                total: dict[int, int] = {}
                hit: dict[int, int] = {}
                for i, c in zip(where, covered):
                    total[i] = total.get(i, 0) + 1
                    hit[i] = hit.get(i, 0) + c
                gone = {i for i in total if hit[i] == total[i]}
                if sum(total[i] for i in gone) >= least:  # however the lines are wrapped
                    keep = [i for i in keep if i not in gone]
            automaton.add(coded)
        yield mid, [i + 1 for i in keep], [lines[i] for i in keep]


def _postscript(lines: list[str], rest: range) -> Iterator[int]:
    on = False
    for i in rest:
        if not lines[i].strip():
            on = False
        elif on or _POSTSCRIPT.match(lines[i]):
            on = True
            yield i


# --- Spark -----------------------------------------------------------------------------------------


def footer_lines(mails: DataFrame, least: int = 5, surely_last: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Lines that recur over senders, nearly always in a last paragraph that is not the first.

    Returns ``key, n`` of every such line (see ``line_key``; lines of any length, however rare), and ``thread, key``
    of the threads that hold it at an end.  A line counts if at least ``least`` senders have it and the share of last
    paragraphs among its occurrences is above ``surely_last`` with 95 % confidence, whatever the size of the corpus.
    """

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[str, str, int, bool]] = []
            for thread, sender, text in zip(batch["thread"], batch["sender"], batch["text"]):
                lines = text.replace("\r", "").split("\n")
                kinds = zones(lines)
                seen: dict[int, bool] = {}
                for a, b in segments(kinds):
                    e = b
                    while e > a and not lines[e - 1].strip():
                        e -= 1
                    p = e
                    while p > a and lines[p - 1].strip() and not _RULE.match(lines[p - 1]):
                        p -= 1
                    for i in range(a, e):
                        if kinds[i] == PLAIN and not _RULE.match(lines[i]):
                            seen[line_key(lines[i])] = i >= p and p > a
                out += [(thread, sender or "", k, last) for k, last in seen.items()]
            yield pd.DataFrame(out, columns=["thread", "sender", "key", "last"])

    lines = mails.select("thread", "sender", "text").mapInPandas(stats, "thread string, sender string, key long, last boolean")
    lines = cut_lineage(lines.select("thread", F.xxhash64("sender").alias("sender"), "key", "last"))
    counted = lines.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(F.col("last"), 1)).alias("m"), F.approx_count_distinct("sender").alias("senders"))
    # The lower end of the Wilson interval of the share m / n.
    z, share = 1.96, F.col("m") / F.col("n")
    lower = (share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))) / (1 + z * z / F.col("n"))
    found = cut_lineage(counted.where((F.col("senders") >= least) & (lower >= surely_last)).select("key", "n"))
    return found, lines.where("last").select("thread", "key")


def distinct_mails(messages: DataFrame) -> DataFrame:
    """One row per mail with text: ``message_id, thread, sender, ordinal, text`` (copies agree)."""
    own = F.coalesce("conversation_id", "message_id")
    return (
        messages.where((F.col("source") == "gmail") & F.col("text").isNotNull() & F.col("message_id").isNotNull())
        .select("message_id", own.alias("thread"), F.col("metadata")["raw_speaker_name"].alias("sender"), "ordinal", "text")
        .groupBy("thread", "message_id")
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("sender", "ordinal", "text")])
    )


def newly_written(messages: DataFrame, least: int = 20, block: int = 400, parts: int = 2000) -> DataFrame:
    """The mails' own text: ``message_id, line_nos ARRAY<INT>, lines ARRAY<STRING>``, a row for each mail with text.

    Mails without text give no row, blank ones a row with empty lists; equal mails under several ids are each
    judged, the later by ``ordinal`` (then id) inheriting from the earlier; null conversations are threads of
    their own; other columns are ignored; an empty table gives an empty result.
    """
    spark = messages.sparkSession
    mails = cut_lineage(distinct_mails(messages))
    found, at_end = footer_lines(mails)
    # Lines in one of ``parts`` mails are few by counting and broadcast; the others go with the threads that hold them.
    often = F.col("n") * parts >= mails.count()
    footers = spark.sparkContext.broadcast(frozenset(r[0] for r in found.where(often).select("key").collect()))
    rare = at_end.join(found.where(~often), "key").groupBy("thread").agg(F.collect_set("key").alias("rare"))
    mails = mails.join(rare, "thread", "left")
    sizes = cut_lineage(mails.groupBy("thread").agg(F.count("*").alias("n")).where(F.col("n") > block))
    out = "message_id string, line_nos array<int>, lines array<string>"

    def judge(own: pd.DataFrame, other: pd.DataFrame | None) -> pd.DataFrame:
        own = own.sort_values(["ordinal", "message_id"], na_position="last")
        sources: list[tuple[int, list[str]]] = []
        if other is not None and len(other):
            place = lambda d: [(pd.isna(o), 0 if pd.isna(o) else o, m) for o, m in zip(d["ordinal"], d["message_id"])]
            mine = place(own)
            other = other.sort_values(["ordinal", "message_id"], na_position="last")
            sources = [(bisect_left(mine, p), list(ws)) for p, ws in zip(place(other), other["words"])]
        known = with_rare(footers.value, own["rare"].iloc[0])
        rows = list(new_lines(list(zip(own["message_id"], own["text"], own["sender"])), sources, known, least))
        return pd.DataFrame({"message_id": [r[0] for r in rows], "line_nos": [r[1] for r in rows], "lines": [r[2] for r in rows]})

    def many(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole threads of a sorted partition; a thread may span batches."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            both = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
            last = both["thread"].iloc[-1]
            ready, rest = both[both["thread"] != last], both[both["thread"] == last]
            held = [rest]
            if len(ready):
                yield pd.concat([judge(g, None) for _, g in ready.groupby("thread", sort=False)], ignore_index=True)
        if held:
            yield judge(held[0], None)

    if sizes.isEmpty():
        return whole_groups(mails, "thread").mapInPandas(many, out)
    cold = mails.join(sizes.select("thread"), "thread", "left_anti")
    hot = mails.join(sizes, "thread").withColumn("block", F.pmod(F.xxhash64("message_id"), F.ceil(F.col("n") / block)).cast("long"))
    hot = cut_lineage(hot.drop("n"))
    parted = hot.groupBy("thread", "block").cogroup(_hot_sources(hot, footers, least).groupBy("thread", "block")).applyInPandas(judge, out)
    return whole_groups(cold, "thread").mapInPandas(many, out).unionByName(parted)


def with_rare(footers: frozenset[int], rare: list[int] | None) -> Set[int]:
    return footers.union(int(k) for k in rare) if rare is not None and len(rare) else footers


def _hot_sources(mails: DataFrame, footers: Broadcast, least: int) -> DataFrame:
    """For each block of a hot thread the words of the mails of other blocks that first hold one of its runs of ``least`` words.

    A match of ``least`` words or more is covered by its runs of ``least`` words, and if an earlier mail holds such a
    run, its first holder is earlier too; so these mails, each added at its place, find all that the whole thread would.
    """

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t, b, o, m, text, sender, rare in zip(*[batch[c] for c in ("thread", "block", "ordinal", "message_id", "text", "sender", "rare")]):
                ws = own_words(text, sender, with_rare(footers.value, rare))
                for g in {" ".join(ws[i : i + least]) for i in range(len(ws) - least + 1)}:
                    h = int.from_bytes(blake2b(g.encode(), digest_size=8).digest(), "little", signed=True)
                    rows.append((t, b, h, None if pd.isna(o) else int(o), m))
            out = pd.DataFrame(rows, columns=["thread", "block", "g", "ordinal", "message_id"])
            yield out.astype({"ordinal": "Int64"})

    def worded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [own_words(x, s, with_rare(footers.value, r)) for x, s, r in zip(batch["text"], batch["sender"], batch["rare"])]
            yield pd.DataFrame({"thread": batch["thread"], "block": batch["block"], "ordinal": batch["ordinal"].astype("Int64"), "message_id": batch["message_id"], "words": words})

    held = cut_lineage(mails.mapInPandas(runs, "thread string, block long, g long, ordinal long, message_id string"))
    first = F.struct(F.col("ordinal").isNull().alias("last"), "ordinal", "message_id", "block")
    holder = held.groupBy("thread", "g").agg(F.min(first).alias("h"))
    wanted = (
        held.select("thread", "g", "block").distinct()
        .join(holder, ["thread", "g"])
        .where(F.col("h.block") != F.col("block"))
        .select("thread", "block", F.col("h.message_id").alias("message_id"))
        .distinct()
    )
    # The text is cut once for each mail that is a source, then dealt to the blocks that want it.
    texts = mails.join(wanted.select("thread", "message_id").distinct(), ["thread", "message_id"], "left_semi").select("thread", "block", "ordinal", "message_id", "text", "sender", "rare")
    words = texts.mapInPandas(worded, "thread string, block long, ordinal long, message_id string, words array<string>").drop("block")
    return wanted.join(words, ["thread", "message_id"]).select("thread", "block", "ordinal", "message_id", "words")
