"""Reading levels by regularised ordinal regression, calibrated to graded texts.

Every sentence is described by word rarity, word length, long words, connectives,
a proxy of clause depth and its length, standardised within its language. A text
has the word-weighted median of each over its sentences, so that one easier or
harder sentence doesn't move it, and its lexical diversity. A proportional-odds
model with an L2 penalty turns these into a latent score and a grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .looks import settle
from .language import _SKIP, plain_word

#: Buckets of the word-frequency sketch; it is the size of what is broadcast, whatever the corpus.
SKETCH = 1 << 18
#: Graded texts used in fitting at most, those of the lowest text hash.
MAX_GRADED = 20_000
RIDGE = 0.005
#: How strongly the slopes of the thresholds are drawn together.
TIE = 0.002
#: Lengths of which one is chosen in each language as that of a long word: where the share of longer words tells the highest grade best from the others.
LONG_CHOICES = range(6, 15)
#: Runs without an end mark are read as sentences of at most this many words.
MAX_SENTENCE = 60
WINDOW_DIVERSITY = 40

# Joining words by language, plain ones and those of demanding prose.
CONNECTIVES = {
    "tt": "һәм ә ләкин чөнки шуңа әмма дип аннары яки",
    "ru": "и а но что когда если чтобы потому поэтому или",
    "en": "and but so because when if that or while then",
    "kk": "және бірақ өйткені сондықтан егер немесе ал",
}
DEMANDING = {
    "tt": "гәрчә бигрәк нәтиҗәдә югарыда әйтелгәнчә караганда вакытта торган шулай булса нигезендә ягъни",
    "ru": "хотя однако несмотря вследствие учётом учетом время поскольку который которая причём следовательно",
    "en": "notwithstanding consequently whereas extent fact although therefore moreover furthermore nevertheless insofar",
    "kk": "қарамастан қатар алайда дегенмен сонымен себебі нәтижесінде байланысты",
}
_SENTENCE = re.compile(r"[^.!?…\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_COMMA = re.compile(r"[,;:—–]")
_LETTERS = re.compile("[a-z]"), re.compile("[әөүҗһ]"), re.compile("[ғқұі]")
_LANGS = ("tt", "ru", "en", "kk")
_JOINS = [frozenset(CONNECTIVES[k].split()) for k in _LANGS]
_HARD = [frozenset(DEMANDING[k].split()) for k in _LANGS]
FEATURES = ("rarity", "word_length", "long_words", "connectives", "demanding", "clauses", "length", "diversity")
CACHE_WORDS = 200_000


def _clean(text: str) -> str:
    text = settle(text)
    return _SKIP.sub(" ", text) if any(mark in text for mark in ("@", "#", "/", "[[", "www.")) else text


def sentences(text: str) -> list[tuple[list[str], int]]:
    """Words as written and inner marks of each sentence; fragments below three words join the one before."""
    out: list[tuple[list[str], int]] = []
    for m in _SENTENCE.finditer(_clean(text)):
        words = _WORD.findall(m[0])
        if not words:
            continue
        marks = len(_COMMA.findall(m[0]))
        if len(words) < 3 and out:
            out[-1] = (out[-1][0] + words, out[-1][1] + marks)
        elif len(words) <= MAX_SENTENCE:
            out.append((words, marks))
        else:
            out += [(words[at : at + MAX_SENTENCE], marks if at == 0 else 0) for at in range(0, len(words), MAX_SENTENCE)]
    return out


def bucket(word: str) -> int:
    """The place of a word in the frequency sketch."""
    return xxhash.xxh64_intdigest(word, 42) & (SKETCH - 1)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, how often each bucket's words occur."""
    counts, cache = np.zeros(SKETCH, np.int64), {}
    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(_WORD.findall(settle(text)))
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for word, n in seen.items():
            at = cache.get(word)
            if at is None:
                at = cache[word] = bucket(plain_word(word))
            counts[at] += n
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])


def word_frequencies(df: DataFrame, text: str) -> np.ndarray:
    """Log relative frequency of each bucket's words over all texts of ``df``, as an array of SKETCH floats.

    Counts are summed within a partition before the shuffle; at most SKETCH pairs
    reach the driver. Words that share a bucket share their count. An empty table
    gives one constant.
    """
    counted = df.select(text).mapInArrow(_words, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(SKETCH)
    n[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return np.log((n + 0.5) / (n.sum() + 0.5 * SKETCH)).astype(np.float32)


class _Words(dict):
    """Row numbers of words as written; the rows hold what the features need of a word."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies, self.rows = frequencies, []

    def __missing__(self, word: str) -> int:
        low = plain_word(word)
        self.rows.append(
            [-self.frequencies[bucket(low)], len(low), word[0].isupper() and not word.isupper()]
            + [len(letters.findall(low)) for letters in _LETTERS]
            + [low in words for words in _JOINS]
            + [low in words for words in _HARD]
        )
        self[word] = len(self.rows) - 1
        return self[word]


class Describer:
    """Features of texts, given the word frequencies of a corpus."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = frequencies
        self.long = np.full(len(_LANGS), 10.0)
        self.centre = np.zeros((len(_LANGS), len(FEATURES) - 1))
        self.spread = np.ones((len(_LANGS), len(FEATURES) - 1))
        self.table = _Words(frequencies)

    def forget(self) -> Describer:
        self.table = _Words(self.frequencies)
        return self

    def _read(self, texts: list[str | None]):
        """Per word: its row and sentence; per sentence: text, marks, language. Names (capitalised inside a sentence) are left out."""
        if len(self.table) > CACHE_WORDS:
            self.forget()
        ids, sizes, owner, marks = [], [], [], []
        number = self.table.__getitem__
        for i, text in enumerate(texts):
            for words, n in sentences(text) if text else ():
                ids += map(number, words)
                sizes.append(len(words))
                owner.append(i)
                marks.append(n)
        facts = np.array(self.table.rows, np.float32).reshape(-1, 14)[np.array(ids, np.int64)]
        sentence = np.repeat(np.arange(len(sizes)), sizes)
        first = np.zeros(len(ids), bool)
        first[np.cumsum([0, *sizes[:-1]])[: len(sizes)]] = True
        kept = first | (facts[:, 2] == 0)
        facts, sentence, ids = facts[kept], sentence[kept], np.array(ids, np.int64)[kept]
        starts = np.flatnonzero(np.diff(sentence, prepend=-1))
        sums = np.add.reduceat(facts.astype(float), starts, axis=0) if len(starts) else np.zeros((0, 14))
        latin, tatar, kazakh, size = sums[:, 3], sums[:, 4], sums[:, 5], sums[:, 1]
        lang = np.where(latin * 2 > size, 2, np.where(kazakh > tatar, 3, np.where(tatar * 30 > size, 0, 1)))
        return ids, facts, sentence, starts, sums, lang, np.array(owner, np.int64), np.array(marks, float)

    def _sentences(self, facts, sentence, starts, sums, lang, marks) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(np.append(starts, len(sentence))).astype(float)
        rows = np.arange(len(n))
        long = np.add.reduceat((facts[:, 1] > self.long[lang][sentence]).astype(float), starts) if len(starts) else np.zeros(0)
        joins, hard = sums[rows, 6 + lang], sums[rows, 10 + lang]
        return np.stack([sums[:, 0] / n, sums[:, 1] / n, long / n, joins / n, hard / n, np.log1p(marks + joins + hard), np.log(n)], axis=1), n

    def settle_scales(self, texts: list[str], grades: list[int]) -> None:
        """What a long word is in each language, and centre and spread of each feature over the sentences of graded texts."""
        _, facts, sentence, starts, sums, lang, owner, marks = self._read(texts)
        if not len(starts):
            return
        high = np.array(grades)[owner] == max(grades)
        n = np.diff(np.append(starts, len(sentence)))
        for k in range(len(_LANGS)):
            mine = lang == k
            if min((mine & high).sum(), (mine & ~high).sum()) >= 8:

                def apart(length: int) -> float:
                    share = np.add.reduceat((facts[:, 1] > length).astype(float), starts) / n
                    a, b = share[mine & ~high], share[mine & high]
                    return (b.mean() - a.mean()) / (a.std() + b.std() + 1e-6)

                self.long[k] = max(LONG_CHOICES, key=apart)
        values, _ = self._sentences(facts, sentence, starts, sums, lang, marks)
        for k in range(len(_LANGS)):
            rows = values[lang == k] if (lang == k).sum() >= 16 else values
            self.centre[k], self.spread[k] = rows.mean(0), rows.std(0) + 1e-6

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Features of the texts that have words, and which they are."""
        ids, facts, sentence, starts, sums, lang, owner, marks = self._read(texts)
        if not len(starts):
            return np.zeros((0, len(FEATURES))), np.zeros(0, np.int64)
        values, weight = self._sentences(facts, sentence, starts, sums, lang, marks)
        values = (values - self.centre[lang]) / self.spread[lang]
        present, begin, which = np.unique(owner, return_index=True, return_inverse=True)
        end = np.append(begin[1:], len(owner))
        total = np.add.reduceat(weight, begin)
        out = np.empty((len(present), len(FEATURES)))
        for k in range(values.shape[1]):
            order = np.lexsort((values[:, k], which))
            run = np.cumsum(weight[order])
            base = np.append(0.0, run[end[:-1] - 1])
            # The first sentence, from low to high, at which half of the text's words are reached.
            reached = np.searchsorted(run, base + total * 0.5 - 1e-9)
            out[:, k] = values[order[np.minimum(reached, end - 1)], k]
        text_of = owner[sentence]
        word_end = np.searchsorted(text_of, present, side="right")
        for row, (lo, hi) in enumerate(zip(np.append(0, word_end[:-1]), word_end)):
            mine = ids[lo:hi].tolist()
            windows = [mine[i : i + WINDOW_DIVERSITY] for i in range(0, max(1, len(mine) - WINDOW_DIVERSITY + 1), WINDOW_DIVERSITY)]
            if len(mine) > WINDOW_DIVERSITY and len(mine) % WINDOW_DIVERSITY:
                windows.append(mine[-WINDOW_DIVERSITY:])  # so that the last words are read as well
            out[row, -1] = (sum(len(set(w)) / len(w) for w in windows) / len(windows) - 0.9) / 0.1
        return out, present


class OrdinalRegression:
    """Partial proportional odds with an L2 penalty: P(grade > k) = sigmoid(x.w_k - threshold_k).

    The slopes of the thresholds are drawn towards one another (``tie``), so what
    makes a text demanding may differ from what makes it more than easy, but only
    as far as the graded texts show it.
    """

    def __init__(self, x: np.ndarray, grades: np.ndarray, ridge: float = RIDGE, tie: float = TIE, steps: int = 2500):
        self.grades = np.unique(grades)
        above = (grades[:, None] > self.grades[None, :-1]).astype(float)
        w, cut = np.zeros((x.shape[1], above.shape[1])), np.zeros(above.shape[1])
        moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(cut), np.zeros_like(cut)]
        for step in range(1, steps + 1):
            p = 1 / (1 + np.exp(-np.clip(x @ w - cut, -30, 30)))
            wrong = (p - above) / max(1, len(x))
            slopes = x.T @ wrong + ridge * w + tie * (w - w.mean(1, keepdims=True))
            for k, (value, grad) in enumerate(((w, slopes), (cut, -wrong.sum(0)))):
                m, v = moments[2 * k], moments[2 * k + 1]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad**2 - v)
                value -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.w, self.cut = w, cut

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of lying above each threshold; a higher threshold is never likelier passed than a lower one."""
        return np.minimum.accumulate(x @ self.w - self.cut, axis=1)

    def grade(self, margins: np.ndarray) -> np.ndarray:
        """The grade above the last threshold that is likelier passed than not."""
        return self.grades[(margins > 0).sum(1)]

    def score(self, margins: np.ndarray) -> np.ndarray:
        """The expected grade, a level on the scale of the graded texts."""
        steps = np.diff(self.grades.astype(float))
        return self.grades[0] + (steps / (1 + np.exp(-np.clip(margins, -30, 30)))).sum(1)


LEVEL = "level int, level_score double, margin double"


def fit(graded: DataFrame, text: str, grade: str, frequencies: np.ndarray) -> tuple[Describer, OrdinalRegression | None]:
    """Features and model from at most MAX_GRADED graded texts; no model if fewer than two grades have texts with words."""
    sample = graded.select(F.col(text).alias("text"), F.col(grade).alias("grade")).where("text IS NOT NULL AND grade IS NOT NULL")
    rows = sample.orderBy(F.xxhash64("text"), "text", "grade").limit(MAX_GRADED).collect()
    describer = Describer(frequencies)
    describer.settle_scales([r.text for r in rows], [r.grade for r in rows])
    x, at = describer.texts([r.text for r in rows])
    grades = np.array([r.grade for r in rows], np.int64)[at]
    return describer.forget(), OrdinalRegression(x, grades) if len(np.unique(grades)) > 1 else None


def grade_texts(df: DataFrame, key: str, text: str, graded: DataFrame, graded_text: str, grade: str) -> DataFrame:
    """``key``, level, level_score (expected level) and margin (log odds of the highest level) of every row.

    A text without words (null, empty, numbers or marks alone) has null in all three;
    so has every text if the graded texts have fewer than two grades. Repeated rows
    stay. Word frequencies are counted over all texts of ``df`` in a first pass; the
    second pass grades without a shuffle.
    """
    spark = df.sparkSession
    describer, model = fit(graded, graded_text, grade, word_frequencies(df, text))
    shared = spark.sparkContext.broadcast((describer, model))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer, model = shared.value
        for batch in batches:
            n = batch.num_rows
            level, score, margin, empty = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.ones(n, bool)
            if model:
                x, at = describer.texts(batch.column(1).to_pylist())
                margins = model.margins(x)
                level[at], score[at], margin[at], empty[at] = model.grade(margins), model.score(margins), margins[:, -1], False
            cols = [pa.array(level, pa.int32(), mask=empty), pa.array(score, mask=empty), pa.array(margin, mask=empty)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["key", "level", "level_score", "margin"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, {LEVEL}").withColumnRenamed("key", key)
