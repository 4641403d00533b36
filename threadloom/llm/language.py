"""Language of every message and of every stretch of it, with a confidence.

Method.  For each language a unigram distribution over the pieces of one fixed public vocabulary (byte-level
pieces, so any script is covered).  The probability of a word is the sum over *all* its segmentations into
pieces, by the forward algorithm; it is fitted by expectation maximisation (forward-backward) on a bounded
sample of labelled messages.  A message is scored word by word; the best sequence of languages under a cost
for switching (cheaper between sentences) gives the stretches, none shorter than ``min_words``.

Words are scored once per worker and kept in a bounded table, so the forward algorithm runs over the distinct
words, not over the text; the sequence search runs over all messages of an Arrow batch at once.
"""

from __future__ import annotations

import base64
import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import small

LANGS = ("en", "de", "fr", "es", "it", "pt", "hi", "ta")
#: A run of more letters is no word and says nothing about the language.
LONGEST_WORD = 60
DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_WORD = re.compile(r"[^\W\d_][\w\u0300-\u036f\u0900-\u0dff'’-]*")
_NOT_LANGUAGE = re.compile(r"\S*@\S+|\b(?:https?://|www\.)\S+|\S*\d\S*")
_STOP = re.compile(r"[.!?…।\n]|:\)|[\U0001F300-\U0001FAFF]")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Place of a public vocabulary file; THREADLOOM_TOKENIZERS overrides the folder."""
    return os.path.join(os.environ.get("THREADLOOM_TOKENIZERS", "/opt/tokenizers"), name)


def load_pieces(path: str, longest: int = 16) -> frozenset[bytes]:
    with open(path, "rb") as f:
        return frozenset(p for line in f if line.strip() and len(p := base64.b64decode(line.split()[0])) <= longest)


class PieceModel:
    """Piece probabilities of all languages, one row of log probabilities per word on demand."""

    def __init__(self, pieces: frozenset[bytes], langs: tuple[str, ...] = LANGS, smoothing: float = 2e-3, cache: int = 400_000) -> None:
        self.langs = langs
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.smoothing = smoothing
        self.p: dict[bytes, np.ndarray] = {}
        self.floor = np.full(len(langs), 1e-9)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(langs)))
        self.cache = cache

    def _edges(self, word: bytes) -> list[tuple[int, int, bytes]]:
        n, longest, pieces = len(word), self.longest, self.pieces
        return [(i, j, w) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1) if (w := word[i:j]) in pieces or j == i + 1]

    def forward(self, word: bytes) -> np.ndarray:
        """Probability of the word in each language, all segmentations summed."""
        alpha = np.zeros((len(word) + 1, len(self.langs)))
        alpha[0] = 1.0
        p, floor = self.p, self.floor
        for i, j, w in self._edges(word):
            alpha[j] += alpha[i] * p.get(w, floor)
        return alpha[-1]

    def fit(self, counts: dict[str, np.ndarray], rounds: int = 4) -> None:
        """Expectation maximisation; ``counts``: occurrences of each word by language."""
        k = len(self.langs)
        self.p = {}
        self.floor = np.full(k, 1e-4)
        words = [(b" " + w.encode(), c) for w, c in counts.items()]
        edges = [self._edges(w) for w, _ in words]
        for _ in range(rounds):
            expected: dict[bytes, np.ndarray] = {}
            for (word, c), es in zip(words, edges):
                n = len(word)
                alpha, beta = np.zeros((n + 1, k)), np.zeros((n + 1, k))
                alpha[0] = beta[n] = 1.0
                get, floor = self.p.get, self.floor
                probs = [get(w, floor) for _, _, w in es]
                for (i, j, _), q in zip(es, probs):
                    alpha[j] += alpha[i] * q
                for (i, j, _), q in zip(reversed(es), reversed(probs)):
                    beta[i] += beta[j] * q
                scale = c / np.maximum(alpha[n], 1e-290)
                for (i, j, w), q in zip(es, probs):
                    x = alpha[i] * q * beta[j] * scale
                    if w in expected:
                        expected[w] += x
                    else:
                        expected[w] = x
            total = sum(expected.values())
            everywhere = {w: x.sum() for w, x in expected.items()}
            whole = sum(everywhere.values())
            s = self.smoothing
            self.p = {w: (1 - s) * x / np.maximum(total, 1e-9) + s * 0.5 * everywhere[w] / whole + s * 0.5 / len(self.pieces) for w, x in expected.items()}
            self.floor = np.full(k, s * 0.5 / len(self.pieces))
        self.known, self.rows = {}, np.zeros((1024, k))

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}, "rows": np.zeros((1024, len(self.langs)))}

    def lookup(self, words: list[str], spread: float = 5.0) -> np.ndarray:
        """Log probabilities relative to the best language, cut at ``-spread``; a row for each word."""
        known = self.known
        if len(known) > self.cache:
            known.clear()
        ids = np.empty(len(words), dtype=np.int64)
        for i, w in enumerate(words):
            k = known.get(w)
            if k is None:
                k = len(known)
                if k >= len(self.rows):
                    self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
                self.rows[k] = 0.0
                if len(w) <= LONGEST_WORD:
                    lp = np.log(np.maximum(self.forward(b" " + w.encode()), 1e-290))
                    self.rows[k] = np.maximum(lp - lp.max(), -spread)
                known[w] = k
            ids[i] = k
        return self.rows[ids]


def words_of(text: str) -> tuple[list[str], list[bool], list[int]]:
    """Lower-case words, whether a sentence ended before each, and their offsets; numbers, codes and addresses are none."""
    text = _NOT_LANGUAGE.sub(lambda m: " " * (len(m.group()) - 1) + ("." if m.group()[-1] in ".!?" else " "), text)
    words, breaks, where, end = [], [], [], 0
    for m in _WORD.finditer(text):
        breaks.append(_STOP.search(text, end, m.start()) is not None)
        words.append(m.group().lower().replace("’", "'"))
        where.append(m.start())
        end = m.end()
    return words, breaks, where


def best_sequences(scores: np.ndarray, breaks: np.ndarray, sizes: np.ndarray, inside: float, between: float) -> np.ndarray:
    """Language index of every word: the best path of each message, all messages stepped together.

    ``scores``: words x languages, message after message; a switch costs ``between`` after a sentence end and
    ``inside`` elsewhere.
    """
    n, k = scores.shape
    path = np.zeros(n, dtype=np.int8)
    if n == 0:
        return path
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    best = np.empty((len(sizes), k))
    back = np.empty((n, k), dtype=np.int8)
    own = np.arange(k, dtype=np.int8)
    for t in range(int(sizes[0])):
        m = int(np.searchsorted(-sizes, -t, side="left"))  # messages longer than t
        at = starts[:m] + t
        if t == 0:
            best[:m] = scores[at]
            continue
        b = best[:m]
        top = b.argmax(1).astype(np.int8)
        cost = np.where(breaks[at], between, inside)
        switched = b[np.arange(m), top] - cost
        stay = b >= switched[:, None]
        back[at] = np.where(stay, own, top[:, None])
        best[:m] = np.where(stay, b, switched[:, None]) + scores[at]
    state = best.argmax(1).astype(np.int8)
    for t in range(int(sizes[0]) - 1, -1, -1):
        m = int(np.searchsorted(-sizes, -t, side="left"))
        at = starts[:m] + t
        path[at] = state[:m]
        if t:
            state[:m] = back[at, state[:m]]
    return path


def _merge_short(runs: list[list], min_words: int) -> list[list]:
    """Runs ``[lang, first, last+1, scores]``; the shortest below the minimum joins the better neighbour."""
    while len(runs) > 1:
        i = min(range(len(runs)), key=lambda r: runs[r][2] - runs[r][1])
        if runs[i][2] - runs[i][1] >= min_words:
            break
        around = [j for j in (i - 1, i + 1) if 0 <= j < len(runs)]
        j = max(around, key=lambda r: (runs[i][3][runs[r][0]], runs[r][2] - runs[r][1]))
        a, b = sorted((i, j))
        runs[a : b + 1] = [[runs[j][0], runs[a][1], runs[b][2], runs[a][3] + runs[b][3]]]
        k = 0
        while k + 1 < len(runs):
            if runs[k][0] == runs[k + 1][0]:
                runs[k : k + 2] = [[runs[k][0], runs[k][1], runs[k + 1][2], runs[k][3] + runs[k + 1][3]]]
            else:
                k += 1
    return runs


def segment_batch(model: PieceModel, texts: list[str], min_words: int = 4, inside: float = 9.0, between: float = 5.0) -> list[list[tuple[int, float, int, int]]]:
    """For each text its stretches: (language index, confidence, offset of the first word, number of words)."""
    flat: list[str] = []
    flags: list[bool] = []
    offsets: list[list[int]] = []
    for t in texts:
        w, b, o = words_of(t)
        flat += w
        flags += b
        offsets.append(o)
    sizes = np.array([len(o) for o in offsets], dtype=np.int64)
    if not len(flat):
        return [[] for _ in texts]
    scores = model.lookup(flat)
    path = best_sequences(scores, np.array(flags), sizes, inside, between)
    sums = np.vstack([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0)])
    out, at = [], 0
    for o in offsets:
        n = len(o)
        if not n:
            out.append([])
            continue
        p = path[at : at + n]
        cuts = [0, *(np.flatnonzero(p[1:] != p[:-1]) + 1).tolist(), n]
        runs = [[int(p[a]), a, b, sums[at + b] - sums[at + a]] for a, b in zip(cuts, cuts[1:])]
        if len(runs) > 1:
            runs = _merge_short(runs, min_words)
        rows = []
        for lang, a, b, s in runs:
            e = np.exp(s - s.max())
            rows.append((lang, float(e[lang] / e.sum()), o[a], b - a))
        out.append(rows)
        at += n
    return out


def label_codes(annotations: DataFrame) -> DataFrame:
    """``message_id, codes``: the two-letter codes of all annotations of a message (empty for none usable)."""
    rows = annotations.select(F.explode("detected_languages").alias("d")).select("d.*").where(F.col("message_id").isNotNull())
    code = F.regexp_extract(F.lower(F.trim("l")), r"^([a-z]{2}) - ", 1)
    return (
        rows.select("message_id", F.explode_outer("languages").alias("l"))
        .groupBy("message_id")
        .agg(F.array_sort(F.array_distinct(F.filter(F.collect_list(F.when(code != "", code)), lambda x: x.isNotNull()))).alias("codes"))
    )


def fit_model(labelled: DataFrame, labels: DataFrame | None = None, vocabulary: str | None = None, rows_per_language: int = 1500, max_chars: int = 2000) -> PieceModel:
    """Fit on a bounded sample: of each language the ``rows_per_language`` labelled texts with the smallest hash.

    Texts of more than ``max_chars`` are not sampled, so the sample is bounded in bytes, too.  The labels are counted
    by language, then those with a hash below twice the share wanted are drawn, which no sort or window needs.

    ``labelled``: ``message_id, text, lang`` with one (possibly wrong) language, or ``message_id, text`` beside
    ``labels`` with ``message_id, lang``; then only the texts of drawn labels are moved.  Copies count once.  The second
    fit takes the words as the first one segments them, so wrong and incomplete labels wash out.  Languages without any
    sample keep the floor probability.
    """
    labels = labelled.select("message_id", "lang") if labels is None else labels
    labels = labels.where(F.col("lang").isin(*LANGS) & F.col("message_id").isNotNull())
    counts = labels.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    bound = F.lit(None).cast("long")
    for lang, n in counts:
        top = 2**63 - 1 if n <= 2 * rows_per_language else -(2**63) + int(2 * rows_per_language / n * 2**64)
        bound = F.when(F.col("lang") == lang, F.lit(top)).otherwise(bound)
    chosen = labels.select("message_id", "lang", F.xxhash64("message_id").alias("h")).where(F.col("h") <= bound).distinct()
    drawn = labelled.where(F.length("text") <= max_chars).select("message_id", "text").join(small(chosen), "message_id")
    drawn = {(r["lang"], r["h"], r["message_id"]): r["text"] for r in drawn.select("lang", "h", "message_id", "text").collect()}
    sample, taken = [], Counter()
    for (lang, _, _), text in sorted(drawn.items()):
        if taken[lang] < rows_per_language:
            taken[lang] += 1
            sample.append((lang, text))
    return fit_on(sample, load_pieces(vocabulary or vocabulary_path()))


def fit_on(sample: list[tuple[str, str]], pieces: frozenset[bytes]) -> PieceModel:
    model = PieceModel(pieces)
    index = {x: i for i, x in enumerate(LANGS)}
    counts: dict[str, np.ndarray] = {}
    for lang, text in sample:
        for w, n in Counter(words_of(text)[0]).items():
            if len(w) <= LONGEST_WORD:
                counts.setdefault(w, np.zeros(len(LANGS)))[index[lang]] += n
    model.fit(counts, rounds=3)
    again: dict[str, np.ndarray] = {}
    for (_, text), runs in zip(sample, segment_batch(model, [t for _, t in sample])):
        words, at = words_of(text)[0], 0
        for lang, confidence, _, n in runs:
            if confidence > 0.9:
                for w in words[at : at + n]:
                    if len(w) <= LONGEST_WORD:
                        again.setdefault(w, np.zeros(len(LANGS)))[lang] += 1
            at += n
    model.fit(again, rounds=3)
    return model


SEGMENTS = "seg_no int, lang string, confidence double, start int, n_words int"


def detect(texts: DataFrame, model: PieceModel, min_words: int = 4) -> DataFrame:
    """``texts`` (``message_id, text`` and more) with ``segments ARRAY<STRUCT<seg_no, lang, confidence, start, n_words>>``.

    Null, empty and wordless texts get an empty array; a text shorter than ``min_words`` one stretch; very long
    texts are searched whole.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)
    schema = [f for f in texts.schema.fields if f.name != "segments"]
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            found = segment_batch(m, [t or "" for t in batch["text"]], min_words)
            batch["segments"] = [[{"seg_no": i, "lang": m.langs[r[0]], "confidence": r[1], "start": r[2], "n_words": r[3]} for i, r in enumerate(rows)] for rows in found]
            yield batch[[*names, "segments"]]

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", segments array<struct<{SEGMENTS.replace(' ', ':').replace(',:', ', ')}>>"
    return texts.mapInPandas(run, ddl)
