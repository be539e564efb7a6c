"""Abusive, hateful and sexual language, by a chain of linear classifiers over sentences.

Human verdicts are on segments, abuse is in sentences. Among the sentences of a
segment judged abusive the likeliest one (by log odds of its features between
abusive and harmless segments) becomes the positive example; sentences of harmless
segments are negatives, those most like abuse first.

The links of the chain are categories: sexual, threat, incitement, insult, and at
last abusive altogether. Each link is a regularised logistic regression over hashed
words, word pairs and letter runs, and over the probabilities of the links before
it; in training these are out-of-fold predictions, so that a later link sees
them as unsure as they will be on new text. The kinds of abuse are not given
in the data: a positive sentence gets its kind from cues at the beginnings of words,
and is an insult otherwise; the links learn from these, and judge sentences without a cue as well. A segment has the score of its worst sentence.

Disguises (look-alikes, separated or repeated letters, masks, shifted spaces) are
undone as far as they can be; letter runs are taken across spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import PlainWords, plain_word
from .looks import settle

#: Feature space of the hashing; it bounds the size of the model that is broadcast.
BITS = 18
#: Reviewed segments used in fitting at most, abusive and harmless, those of the lowest id hash.
MAX_POSITIVE, MAX_NEGATIVE = 3_000, 4_000
#: Of the sentences of harmless segments, those most like abuse, and others, kept as negatives.
HARD_NEGATIVES, EASY_NEGATIVES = 6_000, 2_500
FOLDS = 3
RIDGE = 2e-5
STEPS = 70
THRESHOLD = 0.35
LETTER_RUN = 4
CATEGORIES = ("sexual", "threat", "incitement", "insult")

# How words begin (in Tatar, Russian, English, Kazakh) that tell the kind of a sentence
# already judged abusive; a comma parts them, and a blank stands for any further letters and a blank.
CUES = {
    "incitement": "кеше түгел, бетерергә кирәк, куарга кирәк, җиребезне пычрат, не люди, уничтож, выгнать, изгнать, нашу землю, истреб, vermin, not people, not human, "
    "wiped out, wipe them, expel, drive them, our land, адам емес, қуу керек, жою керек, жерімізді",
    "threat": "сындырам, ярам, үтерәм, табып, үкендер, кайда яшәгән, беркем дә еламас, тумаса, асылын, убью, найду, сломаю, переломаю, выбью, прирежу, ножом, сдохни, удавись, повесься, "
    "не заплачет, не рождал, kill, find you, break your, break you, hang yourself, regret, die, never been born, cry for you, сындырамын, өлтір, тауып, өкін, асылып, ешкім жылама",
    "sexual": "ялангач, чишен, минем белән йокла, тәнеңне, кунакханә, киемсез, голы, голая, голую, раздев, раздень, интим, постел, переспи, naked, nude, undress, sexy, sleep with me, your body, "
    "to bed, hotel, жалаңаш, шешін, менімен ұйықта, денеңді, қонақүй",
}
_CUES = {k: re.compile("|".join(r"(?<![^\W_])" + re.escape(c.strip()).replace(r"\ ", r"[^\W_]* ") for c in v.split(","))) for k, v in CUES.items()}

_APART = re.compile(r"(?<![^\W_])[^\W\d_](?:[._\-*~ ][^\W\d_]){2,}(?![^\W_])|(?<![^\W_])[^\W\d_](?:[._\-~][^\W\d_])+(?![^\W_])")
_SEPARATOR = re.compile(r"[._\-*~ ]")
_AGAIN = re.compile(r"([^\W\d_])\1{2,}")
_END = re.compile(r"[.!?…\n]+|\){2,}|[\U0001f300-\U0001faff❤]+")
_WORD = re.compile(r"[^\W\d_][^\W_]*(?:[*@$0][^\W_]+)*|@[^\W\d_]+(?:[*@$0][^\W_]+)*")
_SWAP = str.maketrans("@$0", "асо")
CACHE_WORDS = 200_000


def undisguise(text: str) -> str:
    """Text with separated letters joined and repeated letters made one."""
    text = settle(text)
    text = _APART.sub(lambda m: _SEPARATOR.sub("", m[0]), text)
    return _AGAIN.sub(r"\1", text)


class _Plain(PlainWords):
    """Words as they stand in the text to words in one script, masks inside a word staying as an asterisk."""

    def __missing__(self, word: str) -> str:
        if word.isalpha():
            return super().__missing__(word)
        return plain_word(word.translate(_SWAP))


_PLAIN = _Plain()


def sentence_words(text: str) -> list[list[str]]:
    """The words of each sentence that has any, in one script."""
    return [[_PLAIN[w] for w in words] for part in _END.split(undisguise(text)) if (words := _WORD.findall(part))]


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = number = xxhash.xxh64_intdigest(word) >> 20
        return number


class Features:
    """Hashed features of sentences: words, pairs of words, and runs of letters across spaces."""

    def __init__(self):
        self.numbers = _Numbers()

    def batch(self, sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The feature numbers of all sentences and the sentence of each, in no particular order."""
        n = len(sentences)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        number = self.numbers.__getitem__
        ids: list[int] = []
        for words in sentences:
            ids += map(number, words)
        word = np.array(ids, np.uint64)
        row = np.repeat(np.arange(n), [len(w) for w in sentences])
        pair = row[1:] == row[:-1]
        pairs = (word[:-1] * np.uint64(31) + word[1:] * np.uint64(0x9E3779B97F4A7C15))[pair]
        joined = ["".join(w) for w in sentences]
        codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        letters_row = np.repeat(np.arange(n), [len(j) for j in joined])
        span = LETTER_RUN - 1
        run = np.zeros(max(0, len(codes) - span), np.uint64)
        for k in range(LETTER_RUN if len(run) else 0):
            run = run * np.uint64(1_000_003) + codes[k : len(codes) - span + k]
        whole = letters_row[span:] == letters_row[: max(0, len(letters_row) - span)]
        salt = np.uint64(0xD6E8FEB86659FD93)
        every = np.concatenate([word, pairs + np.uint64(7), run[whole] + np.uint64(13)])
        rows = np.concatenate([row, row[1:][pair], letters_row[span:][whole]])
        return ((every * salt) >> np.uint64(64 - BITS)).astype(np.int64), rows


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _values(row: np.ndarray, n: int) -> np.ndarray:
    """The value of each feature: a sentence of k features has 1/sqrt(k) for each."""
    return (1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1)))[row]


class Chain:
    """The fitted links: per link a weight for each feature, for each earlier link, and a bias."""

    def __init__(self, names: list[str]):
        self.names = names
        self.weights = np.zeros((len(names), 1 << BITS), np.float32)
        self.before = np.zeros((len(names), len(names)))
        self.bias = np.full(len(names), -30.0)

    def predict(self, features: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Probability of each link for each of ``n`` sentences."""
        value = _values(row, n)
        out = np.zeros((n, len(self.names)))
        for k in range(len(self.names)):
            line = np.bincount(row, self.weights[k][features] * value, n) + out @ self.before[k] + self.bias[k]
            out[:, k] = _sigmoid(line)
        return out


def _logistic(columns, row, value, n, width, dense, target, weight):
    """Weights of a ridge logistic regression over sparse and dense columns, by full-batch Adam."""
    w, v, b = np.zeros(width), np.zeros(dense.shape[1]), float(np.log((target @ weight + 1) / ((1 - target) @ weight + 1)))
    total = weight.sum()
    m1, m2 = [np.zeros(width), np.zeros(dense.shape[1]), 0.0], [np.zeros(width), np.zeros(dense.shape[1]), 0.0]
    for step in range(1, STEPS + 1):
        p = _sigmoid(np.bincount(row, w[columns] * value, n) + dense @ v + b)
        wrong = (p - target) * weight / total
        grads = [np.bincount(columns, wrong[row] * value, width) + RIDGE * w, dense.T @ wrong + RIDGE * v, wrong.sum()]
        params = [w, v, b]
        for k, g in enumerate(grads):
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            params[k] = params[k] - 0.35 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-9)
        w, v, b = params
    return w, v, b


def kind_by_cue(words: list[str]) -> str:
    """The kind of an abusive sentence: the first whose cues it has, else an insult."""
    sentence = " ".join(words)
    return next((name for name, cue in _CUES.items() if cue.search(sentence)), "insult")


def fit_chain(texts: list[str], abusive: list[int]) -> Chain:
    """A chain from segments judged abusive (1) or not (0). Without both kinds no link ever fires."""
    chain = Chain([*CATEGORIES, "abusive"])
    sentences, owner = [], []
    for i, text in enumerate(texts):
        found = sentence_words(text)
        sentences += found
        owner += [i] * len(found)
    owner_, label = np.array(owner, np.int64), np.array(abusive)
    if not len(owner_) or len(set(label[owner_])) < 2:
        return chain
    features, row = Features().batch(sentences)
    value = _values(row, len(sentences))
    of_abusive = label[owner_] == 1
    # Log odds of features between abusive and harmless segments (each counted once a segment).
    seen = np.unique(owner_[row] << BITS | features)
    seen_by, seen_feature = label[seen >> BITS], seen & ((1 << BITS) - 1)
    hits = [np.bincount(seen_feature[seen_by == k], minlength=1 << BITS) for k in (0, 1)]
    n0, n1 = (label == 0).sum(), (label == 1).sum()
    odds = np.log((hits[1] + 0.3) / (n1 + 0.6)) - np.log((hits[0] + 0.3) / (n0 + 0.6))
    likeness = np.bincount(row, odds[features] * value, len(sentences))
    order = np.lexsort((-likeness, owner_))
    best = order[np.unique(owner_[order], return_index=True)[1]]
    positive = best[label[owner_[best]] == 1]
    negative = np.flatnonzero(~of_abusive)
    negative = negative[np.argsort(-likeness[negative], kind="stable")]
    rest = negative[HARD_NEGATIVES:]
    negative = np.concatenate([negative[:HARD_NEGATIVES], rest[:: max(1, -(-len(rest) // EASY_NEGATIVES))]])
    chosen = np.concatenate([positive, negative])
    target = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))])
    # The columns that occur in the chosen sentences at least twice, closely numbered.
    features, row = Features().batch([sentences[i] for i in chosen])
    value = _values(row, len(chosen))
    count = np.bincount(features, minlength=1 << BITS)
    used = np.flatnonzero(count > 1)
    number = np.full(1 << BITS, -1)
    number[used] = np.arange(len(used))
    kept = number[features] >= 0
    columns, row, value = number[features[kept]], row[kept], value[kept]
    n = len(chosen)
    kinds = {}
    free = target == 1
    for name in CUES:
        hit = np.array([bool(kind_by_cue(sentences[i]) == name) for i in chosen]) & free
        kinds[name], free = hit, free & ~hit
    kinds["insult"] = free
    kinds["abusive"] = target == 1
    fold = owner_[chosen] % FOLDS
    weight = np.where(target == 1, max(1.0, 0.5 * len(negative) / max(1, len(positive))), 1.0)
    outside = np.zeros((n, len(chain.names)))
    for k, name in enumerate(chain.names):
        wanted = kinds[name].astype(float)
        if wanted.sum() < 3:
            continue
        dense = outside[:, :k]
        for f in range(FOLDS):
            train, test = fold != f, fold == f
            mine = train[row]
            renumber = np.cumsum(train) - 1
            w, v, b = _logistic(columns[mine], renumber[row[mine]], value[mine], int(train.sum()), len(used), dense[train], wanted[train], weight[train])
            theirs = test[row]
            line = np.bincount(row[theirs], w[columns[theirs]] * value[theirs], n) + dense @ v + b
            outside[test, k] = _sigmoid(line[test])
        w, v, b = _logistic(columns, row, value, n, len(used), dense, wanted, weight)
        chain.weights[k, used], chain.before[k, :k], chain.bias[k] = w, v, b
    return chain


SCORES = "toxicity double, category string, sexual double, threat double, incitement double, insult double"


def score_segments(texts: list[str | None], chain: Chain, features: Features) -> np.ndarray:
    """Probability of each link for each text: those of its worst sentence; NaN without words."""
    sentences, owner = [], []
    for i, text in enumerate(texts):
        found = sentence_words(text) if text else []
        sentences += found
        owner += [i] * len(found)
    out = np.full((len(texts), len(chain.names)), np.nan)
    if sentences:
        scores = chain.predict(*features.batch(sentences), len(sentences))
        order = np.lexsort((-scores[:, -1], np.array(owner)))
        present, first = np.unique(np.array(owner)[order], return_index=True)
        out[present] = scores[order[first]]
    return out


def fit(segments: DataFrame, key: str, text: str, reviews: DataFrame, review_key: str, verdict: str) -> Chain:
    """A chain from at most MAX_POSITIVE abusive and MAX_NEGATIVE harmless reviewed segments.

    A segment with several verdicts is abusive if one of them says so; of several
    texts under one key the least counts. Null verdicts and texts are left out.
    """
    judged = reviews.where(F.col(verdict).isin(0, 1)).groupBy(F.col(review_key).alias("key")).agg(F.max(verdict).alias("abusive"))
    # The bound is put on the verdicts, so what is broadcast to the segments is small whatever the tables.
    sample = [judged.where(F.col("abusive") == k).orderBy(F.xxhash64("key"), "key").limit(most) for k, most in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    known = segments.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL").join(F.broadcast(sample[0].unionByName(sample[1])), "key")
    rows = known.groupBy("key", "abusive").agg(F.min("text").alias("text")).orderBy(F.xxhash64("key"), "key").select("text", "abusive").collect()
    return fit_chain([r.text for r in rows], [r.abusive for r in rows])


def score(df: DataFrame, keep: list[str], text: str, chain: Chain) -> DataFrame:
    """``keep``, toxicity (probability of abuse), the likeliest category, and the probability of each, for every row.

    A text without words (null, empty, marks alone) has toxicity 0 and no category.
    The category is null below THRESHOLD. Repeated rows stay. One pass, no shuffle.
    """
    source = df.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(text).alias("text"))
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    shared = df.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, features = shared.value, Features()
        for batch in batches:
            scores = np.nan_to_num(score_segments(batch.column(len(keep)).to_pylist(), chain, features))
            worst = scores[:, : len(CATEGORIES)].argmax(1)
            names = [CATEGORIES[k] if p >= THRESHOLD else None for k, p in zip(worst, scores[:, -1])]
            cols = [pa.array(scores[:, -1].copy()), pa.array(names, pa.string()), *(pa.array(scores[:, k].copy()) for k in range(len(CATEGORIES)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *cols], names=[*keep, *(f.split()[0] for f in SCORES.split(", "))])

    return source.mapInArrow(run, ", ".join([*fields, SCORES]))
