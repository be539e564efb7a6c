"""Languages of texts that may mix several, by expectation-maximisation over n-gram likelihoods.

Models of characters in context (word-bounded n-grams) are fitted on a small set of
texts of known language. A text is taken as a mixture: its clauses (runs of at
most ``UNIT_WORDS`` words between marks) are draws from a few languages, each
clause from one. EM estimates the proportions, in words; nested language sets are
compared by penalised likelihood, and the best set gives the shares.

Links, addresses, mentions, hashtags and numbers are not words of any language.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .looks import LATIN, TO_CYRILLIC, TO_LATIN, settle

LANGUAGES = ("tt", "ru", "en", "kk")
#: A language with this share of the words counts towards a mixed text.
MIXED_SHARE = 0.3
#: A proportion below this is none: EM takes what a language doesn't have to nothing, but not to zero.
LEAST_SHARE = 1e-3
UNIT_WORDS = 5
NGRAMS = (1, 2, 3, 4)
#: Texts per language on which a model is fitted at most; a documented bound of the sample.
MAX_FIT_TEXTS = 2_000
EM_STEPS = 12
#: Penalty for each further language, in nats per log of the number of words.
PENALTY = 3.0
CACHE_WORDS = 200_000
# A word's evidence is bounded, so that one odd word doesn't decide a clause.
WORD_CAP = 12.0

_SKIP = re.compile(r"(?:https?://|www\.)\S+|\S+@\S+|[@#]\w+|\[\[[^\[\]]*\]\]|\b[\w-]+(?:\.[\w-]+)+/\S*", re.I)
_PIECE = re.compile(r"[^\W\d_]+|[.!?…,;:\n()]")
_LATIN_OWN = re.compile("[^\\W\\d_" + LATIN + "Ͱ-\u1cff]")
_CYRILLIC_OWN = re.compile("[б-дж-нптфц-яёғҗқңүұБГДЖЗИЙЛПФЦ-ЯЁҒҖҚҢҰ]")

# In a Cyrillic word small Latin letters that resemble capitals are read as such.
_TO_CYRILLIC = TO_CYRILLIC | str.maketrans("kmtb", "кмтв")


def plain_word(word: str) -> str:
    """A word in one script, by its own letters, and lower-cased; look-alikes follow them while they still have their case."""
    if word.isascii():
        return word.lower()
    latin, cyrillic = len(_LATIN_OWN.findall(word)), len(_CYRILLIC_OWN.findall(word))
    return word.translate(TO_LATIN if latin > cyrillic else _TO_CYRILLIC).lower()


class PlainWords(dict):
    """A cache of :func:`plain_word`, started afresh when it is full."""

    def __missing__(self, word: str) -> str:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = plain = plain_word(word)
        return plain


_PLAIN = PlainWords()


def units(text: str) -> list[list[str]]:
    """The clauses of a text, each a list of at most UNIT_WORDS plain words."""
    out: list[list[str]] = [[]]
    text = settle(text)
    if any(mark in text for mark in ("@", "#", "/", "[[", "www.")):
        text = _SKIP.sub(" ", text)
    for piece in _PIECE.findall(text):
        if piece[0].isalpha():
            if len(out[-1]) == UNIT_WORDS:
                out.append([])
            out[-1].append(_PLAIN[piece])
        elif out[-1]:
            out.append([])
    if not out[-1]:
        out.pop()
    # A lone word (a name, a shout) says little: it joins the clause before it.
    joined: list[list[str]] = []
    for unit in out:
        if joined and len(unit) == 1 and len(joined[-1]) < 2 * UNIT_WORDS:
            joined[-1] += unit
        else:
            joined.append(unit)
    return joined


class LanguageModels:
    """Log-likelihoods of a word under each language, from n-grams and whole words."""

    def __init__(self, texts: list[tuple[str, str]]):
        grams = {lang: [Counter() for _ in NGRAMS] for lang in LANGUAGES}
        words = {lang: Counter() for lang in LANGUAGES}
        for lang, text in texts:
            for unit in units(text):
                words[lang].update(unit)
        for lang in LANGUAGES:
            for word, n in words[lang].items():
                # Frequent words would drown the forms that tell languages apart.
                weight = 1 + np.log(n)
                for k, order in enumerate(NGRAMS):
                    for gram in self._grams(word, order):
                        grams[lang][k][gram] += weight
        self.tables = []
        for k, order in enumerate(NGRAMS):
            every = sorted(set().union(*(grams[lang][k] for lang in LANGUAGES)))
            table = np.array([[grams[lang][k].get(g, 0.0) for lang in LANGUAGES] for g in every]).reshape(len(every), len(LANGUAGES)) + 0.3
            total = table.sum(0) + 0.3 * (1 + len(every))
            log = np.log(table / total)
            self.tables.append(({g: i for i, g in enumerate(every)}, log, np.log(0.3 / total)))
        self.cache: dict[str, np.ndarray] = {}

    @staticmethod
    def _grams(word: str, order: int) -> list[str]:
        bounded = word if order == 1 else f"^{word}$"
        return [bounded[i : i + order] for i in range(len(bounded) - order + 1)]

    def word(self, word: str) -> np.ndarray:
        known = self.cache.get(word)
        if known is None:
            known = np.zeros(len(LANGUAGES))
            for order, (index, log, unseen) in zip(NGRAMS, self.tables):
                for gram in self._grams(word, order):
                    at = index.get(gram)
                    known = known + (unseen if at is None else log[at])
            known = known / len(NGRAMS)
            known = np.maximum(known - known.max(), -WORD_CAP)
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = known
        return known

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the share of its words in each language, and a confidence; zeros without words."""
        rows, weights, owner = [], [], []
        for i, text in enumerate(texts):
            for unit in units(text) if text else []:
                rows.append(sum(self.word(w) for w in unit))
                weights.append(len(unit))
                owner.append(i)
        result, sure = np.zeros((len(texts), len(LANGUAGES))), np.zeros(len(texts))
        if rows:
            owner_of = np.array(owner)
            present, starts, inverse = np.unique(owner_of, return_index=True, return_inverse=True)
            result[present], sure[present] = mixture(np.array(rows), np.array(weights, float), starts, inverse)
        return result, sure


def _em(log: np.ndarray, weight: np.ndarray, starts: np.ndarray, owner: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages of each text, and its log-likelihood."""
    likely = np.exp(log)
    share = allowed / allowed.sum(1, keepdims=True)
    total = np.add.reduceat(weight, starts)[:, None]
    for _ in range(EM_STEPS):
        joint = likely * share[owner]
        joint *= (weight / np.maximum(joint.sum(1), 1e-300))[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / total
    value = np.log(np.maximum((likely * share[owner]).sum(1), 1e-300))
    return share, np.add.reduceat(value, starts)


def mixture(log: np.ndarray, weight: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The EM proportions under the language set of the best penalised likelihood, and the confidence in its leading languages.

    The sets compared are nested: the largest one, two, ... and at last all languages
    of an unrestricted EM. The confidence is the mean posterior of the clauses' best language.
    """
    peak = log.max(1, keepdims=True)
    log = log - peak
    free, free_value = _em(log, weight, starts, owner, np.ones((len(starts), log.shape[1])))
    rank = np.argsort(np.argsort(-free, axis=1, kind="stable"), axis=1)
    size = np.log(np.maximum(np.add.reduceat(weight, starts), 2.0))
    best, best_value = None, None
    for k in range(1, log.shape[1] + 1):
        share, value = (free, free_value) if k == log.shape[1] else _em(log, weight, starts, owner, (rank < k).astype(float))
        value = value - PENALTY * (k - 1) * size
        if best is None:
            best, best_value = share, value
        else:
            better = value > best_value
            best = np.where(better[:, None], share, best)
            best_value = np.maximum(value, best_value)
    posterior = np.exp(log) * best[owner]
    posterior /= np.maximum(posterior.sum(1, keepdims=True), 1e-300)
    sure = np.add.reduceat(posterior.max(1) * weight, starts) / np.add.reduceat(weight, starts)
    best = np.where(best < LEAST_SHARE, 0.0, best)
    return best / best.sum(1, keepdims=True), sure


def fit(spark, labelled: DataFrame, lang: str, text: str) -> LanguageModels:
    """Models from at most MAX_FIT_TEXTS texts of each language, those of the lowest text hash.

    Rows with a null text or another language are ignored. A language without texts
    keeps a flat model, which no text prefers.
    """
    known = labelled.select(F.lower(F.trim(lang)).alias("lang"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    # A sort with a limit keeps the least of every partition, so no task holds all rows of a language.
    samples = [known.where(F.col("lang") == k).orderBy(F.xxhash64("text"), "text").limit(MAX_FIT_TEXTS) for k in LANGUAGES]
    rows = reduce(DataFrame.unionByName, samples).collect()
    return LanguageModels([(r.lang, r.text) for r in sorted(rows, key=lambda r: (r.lang, r.text))])


def document_language(shares: np.ndarray) -> list[str | None]:
    """tt, ru, en or kk, mul if two have MIXED_SHARE of the words, None without words; ties go to the first of LANGUAGES."""
    second = np.sort(shares, axis=1)[:, -2]
    return [None if not s.any() else "mul" if two >= MIXED_SHARE else LANGUAGES[int(s.argmax())] for s, two in zip(shares, second)]


def segment_language(shares: np.ndarray) -> list[str | None]:
    """tatar, russian, mixed (both have MIXED_SHARE of the words) or other; None without words."""
    tt, ru = LANGUAGES.index("tt"), LANGUAGES.index("ru")
    names = {tt: "tatar", ru: "russian"}
    return [
        None if not s.any() else "mixed" if min(s[tt], s[ru]) >= MIXED_SHARE else names.get(int(s.argmax()), "other")
        for s in shares
    ]


SHARES = "language string, confidence double, tt double, ru double, en double, kk double"


def label_languages(df: DataFrame, keep: list[str], text: str, models: LanguageModels, naming=document_language) -> DataFrame:
    """``keep``, language, confidence and the share of words of each language for every row.

    A text without words of a language (null, empty, links or numbers alone) has a
    null language and confidence 0. Repeated rows stay. One pass, no shuffle.
    """
    source = df.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(text).alias("text"))
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    shared = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            shares, sure = models.shares(batch.column(len(keep)).to_pylist())
            cols = [pa.array(naming(shares), pa.string()), pa.array(sure), *(pa.array(shares[:, k].copy()) for k in range(len(LANGUAGES)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *cols], names=[*keep, *(f.split()[0] for f in SHARES.split(", "))])

    return source.mapInArrow(run, ", ".join([*fields, SHARES]))


def language_spans(df: DataFrame, key: str, text: str, models: LanguageModels) -> DataFrame:
    """The runs of clauses in one language of every text that mixes two: key, span_no, language, confidence, n_words.

    Texts of one language or without words give no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            shares, _ = models.shares(texts)
            at, rows = [], []
            for i in np.flatnonzero((shares > 0).sum(1) > 1):
                spans: list[list] = []
                for unit in units(texts[i]):
                    value = sum(models.word(w) for w in unit)
                    value = np.exp(value - value.max()) * shares[i]
                    value /= max(value.sum(), 1e-300)
                    best = int(value.argmax())
                    if spans and spans[-1][0] == best:
                        spans[-1][1] += len(unit)
                        spans[-1][2] += float(value[best]) * len(unit)
                    else:
                        spans.append([best, len(unit), float(value[best]) * len(unit)])
                for n, (best, words, sure) in enumerate(spans):
                    at.append(i)
                    rows.append((n, LANGUAGES[best], sure / words, words))
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.string(), pa.float64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *cols], names=["key", "span_no", "language", "confidence", "n_words"])

    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(run, f"key {kind}, span_no int, language string, confidence double, n_words int").withColumnRenamed("key", key)


USABLE = ("tatar", "russian", "mixed", "other")


def payload_language(payload: str | None) -> str | None:
    """``main_language`` of a label payload, wrapped or not, in lower case; None if unreadable or not usable."""
    try:
        parsed = json.loads(payload)
        if isinstance(parsed, dict) and "main_language" not in parsed and isinstance(parsed.get("labels"), dict):
            parsed = parsed["labels"]
        value = parsed.get("main_language")
    except (TypeError, ValueError, AttributeError, RecursionError):
        return None
    value = value.strip().lower() if isinstance(value, str) else None
    return value if value in USABLE else None


def payload_languages(df: DataFrame, key: str, payload: str, text: str, models: LanguageModels) -> DataFrame:
    """``key``, given (from the payload) and language (from the text) of every row, with confidence and shares."""
    source = df.select(F.col(key).alias("k0"), F.col(payload).alias("payload"), F.col(text).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(models)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            shares, sure = models.shares(batch.column(2).to_pylist())
            given = [payload_language(p) for p in batch.column(1).to_pylist()]
            cols = [pa.array(given, pa.string()), pa.array(segment_language(shares), pa.string()), pa.array(sure), *(pa.array(shares[:, k].copy()) for k in range(len(LANGUAGES)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["key", "given", *(f.split()[0] for f in SHARES.split(", "))])

    return source.mapInArrow(run, f"key {kind}, given string, {SHARES}").withColumnRenamed("key", key)
