"""Toxicity, consistent forms, languages, splitting, tokens, leaks, levels: on small fixtures and against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import language, leak, level, looks, split, tokenize, toxicity
from textloom.plans.shared import materialise

DATA = "/root/testdata/sf0.01"


def by_key(df, key, *columns):
    return {r[key]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns)) for r in df.collect()}


# ---- p1


def test_disguises():
    plain = toxicity.sentence_words("ахмак")[0]
    for text in ("@хм@к", "а.х.м.а.к", "а_х_м_а_к", "аaaхмак"[0:1] + "хмак", "axмak"):
        assert toxicity.sentence_words(text)[0] == plain, text
    assert toxicity.sentence_words("мөөөөртәт")[0] == ["мөртәт"]
    assert toxicity.sentence_words("") == [] and toxicity.sentence_words("!!! \U0001f642") == []


def test_chain_and_scores(spark):
    rng = random.Random(0)
    filler = [f"{a} {b} {c}" for a in ("зур", "ак", "кара") for b in ("йорт", "су", "китап") for c in ("килде", "торды", "укый")]
    bad = ["син чын ахмак икән", "сине табып үкендерәм әле", "ялангач фотоңны җибәр"]
    fine = ["ахмак бүре исемле әкият укыдык", "үземне тиле дип көлдем"]
    texts, labels = [], []
    for i in range(240):
        parts = rng.sample(filler, 3)
        if i % 3 == 0:
            parts.insert(rng.randrange(3), bad[i // 3 % 3])
        elif i % 3 == 1:
            parts.insert(rng.randrange(3), fine[i % 2])
        texts.append(". ".join(parts) + ".")
        labels.append(int(i % 3 == 0))
    chain = toxicity.fit_chain(texts[:160], labels[:160])
    scores = toxicity.score_segments(texts[160:], chain, toxicity.Features())[:, -1]
    assert ((scores >= toxicity.THRESHOLD) == np.array(labels[160:], bool)).mean() > 0.95
    rows = [(1, texts[0]), (1, texts[0]), (2, None), (3, ""), (4, "\U0001f642"), (5, texts[1] * 300)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("text", F.lit("clash")).withColumn("toxicity_", F.lit(0))
    got = toxicity.score(df, ["id"], "t", chain)
    assert got.count() == 6
    found = by_key(got, "id", "toxicity", "category")
    assert found[1][0] > 0.5 and found[1][1] in toxicity.CATEGORIES and found[2] == found[3] == found[4] == (0.0, None) and found[5][0] < 0.5
    assert toxicity.score(df.limit(0), ["id"], "t", chain).count() == 0


def test_fit_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, text string, abusive int")
    chain = toxicity.fit(empty, "id", "text", empty, "id", "abusive")
    assert toxicity.score(spark.createDataFrame([("a", "x y")], "id string, t string"), ["id"], "t", chain).first().toxicity < 1e-6


def test_toxicity_held_out(spark):
    segments = spark.read.parquet("/root/testdata/sf0.1/toxicity_segments.parquet").select("id", "text")
    reviews = spark.read.parquet("/root/testdata/sf0.1/toxicity_reviews.parquet")
    train, test = reviews.where("abs(xxhash64(id)) % 4 <> 0"), reviews.where("abs(xxhash64(id)) % 4 = 0")
    chain = toxicity.fit(segments, "id", "text", train, "id", "abusive")
    scored = toxicity.score(segments.join(test, "id").dropDuplicates(["id"]), ["id", "abusive"], "text", chain).toPandas()
    said, true = scored.toxicity >= toxicity.THRESHOLD, scored.abusive == 1
    assert (said & true).sum() / said.sum() > 0.95 and (said & true).sum() / true.sum() > 0.85


# ---- p2


def test_settled_forms():
    assert looks.settle("ａｂｃ！") == "abc!"
    assert looks.settle("a\u00a0b\u2009c\u3000d") == "a b c d"
    assert looks.settle("и\u0306") == "й" and looks.settle("a\u00adb\u200bc\u2060") == "abc"
    farmer = "\U0001f469\u200d\U0001f33e"
    assert looks.settle(farmer) == farmer and looks.settle("а\u200dб\u200c") == "аб" and looks.settle("❤\ufe0f") == "❤\ufe0f"
    assert looks.settle("a…") == "a..."


def test_repair_candidates():
    assert looks.candidates("мacтep", "cyrillic") == ["мастер"]
    assert looks.candidates("hоusе", "latin") == ["house"]
    assert looks.candidates("оса", "cyrillic") == [] and looks.candidates("oca", "cyrillic") == ["оса"]
    assert looks.candidates("дом", "cyrillic") == [] and looks.candidates("house", "cyrillic") == []


def test_consistent_form_and_pairs(spark):
    rows = [
        (1, "мастер пришёл домой"), (2, "мacтep пришёл домой"), (3, "мастер\u00a0пришёл домой"), (4, "Мастер пришёл домой"), (5, "мастер пришел домой"),
        (6, "фжzщ"), (7, None), (8, ""), (9, ""), (10, "мастер пришёл домой"), (11, "нoвoе cлово тут"), (12, "новoе слoво тут"),
    ]
    df = spark.createDataFrame(rows, "seq long, text string").withColumn("form", F.lit("clash")).withColumn("raw", F.lit(1))
    form = by_key(looks.consistent_form(df, "seq", "text", materialise), "key", "form")
    assert form[1] == form[2] == form[3] == form[10] != form[4] and form[5] != form[1]
    assert form[6] == "фжzщ" and form[7] is None and form[8] == ""
    assert form[11] == form[12] == "новое слово тут"  # two spellings agree, though neither is clean
    pairs = {(r.key_a, r.key_b) for r in looks.same_look_pairs(df, "seq", "text", materialise).collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3), (2, 10), (3, 10), (11, 12)}
    assert looks.same_look_pairs(df.limit(0), "seq", "text", materialise).count() == 0


# ---- p4


@pytest.fixture(scope="module")
def models(spark):
    known = spark.read.parquet(f"{DATA}/level_samples.parquet").select("lang", "text").unionByName(spark.read.parquet(f"{DATA}/eval_items.parquet").select("lang", "text"))
    return language.fit(spark, known, "lang", "text")


def test_languages(spark, models):
    tt, ru, en = "Матур китап кичә мәктәптә укылды, ә балалар җырлады.", "Вчера большая собака гуляла по улице, и дети смеялись.", "The old farmer counted the apples behind the house."
    rows = [(1, tt), (2, ru), (3, en), (4, f"{tt} {ru}"), (5, f"{tt} {tt} {tt} {ru}"), (6, None), (7, ""), (8, "12 34 !!"), (9, "https://a.example/kitap #тег @имя"), (10, f"{tt} https://net.example/very/long/english/words"), (1, tt), (11, f"{tt} " * 400)]
    df = spark.createDataFrame(rows, "i int, t string").withColumn("text", F.lit("x")).withColumn("key", F.lit(1))
    done = language.label_languages(df, ["i"], "t", models)
    assert done.count() == len(rows)
    got = by_key(done, "i", "language")
    assert got == {1: "tt", 2: "ru", 3: "en", 4: "mul", 5: "tt", 6: None, 7: None, 8: None, 9: None, 10: "tt", 11: "tt"}
    assert by_key(language.label_languages(df, ["i"], "t", models, language.segment_language), "i", "language")[4] == "mixed"
    spans = language.language_spans(df.where("i IN (1, 4)"), "i", "t", models).orderBy("span_no").collect()
    assert {r.i for r in spans} == {4} and [r.language for r in spans] == ["tt", "ru"]
    assert language.label_languages(df.limit(0), ["i"], "t", models).count() == 0


def test_all_languages_in_one_text():
    """Clauses of every language, each plainly its own, keep their share; a text of one language stays one."""
    n = len(language.LANGUAGES)
    log = np.where(np.eye(n)[[*range(n), *range(n), 0, 0]] > 0, 0.0, -60.0)
    shares, sure = language.mixture(log, np.full(len(log), 8.0), np.array([0, 2 * n]), np.array([0] * 2 * n + [1, 1]))
    assert np.allclose(shares, [[1 / n] * n, [1.0] + [0.0] * (n - 1)]) and np.all(sure > 0.99)


def test_payload_language():
    read = language.payload_language
    assert read('{"main_language": " Tatar "}') == "tatar" and read('{"labels": {"main_language": "MIXED"}}') == "mixed"
    assert [read(x) for x in (None, "", "{", "[]", "1", '{"main_language": 3}', '{"main_language": "klingon"}', '{"labels": 1}', '{"main_language": "tatar"')] == [None] * 9


def test_language_accuracy(spark, models):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language.label_languages(docs, ["lang"], "text", models).where("language IS NOT NULL AND lower(lang) IN ('tt', 'ru', 'en', 'kk', 'mul')")
    # About one label in twenty is wrong in the data itself.
    assert got.where("lower(lang) = language").count() / got.count() > 0.92


# ---- p5

TEXT = st.text(st.sampled_from("ab .,\n!\u0301\U0001f469\u200dя"), max_size=400)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(2, 60), st.integers(0, 20))
def test_pieces(text, limit, overlap):
    if overlap >= limit:
        with pytest.raises(ValueError):
            split.pieces(text, limit, overlap)
        return
    got = split.pieces(text, limit, overlap)
    assert "".join(text[s:e] for _, s, e in got) == text
    for n, (begin, start, end) in enumerate(got):
        assert end - begin <= limit and (begin == start if n == 0 else max(got[n - 1][1], start - overlap) <= begin <= start)
        assert end > start or not text


def test_natural_boundaries():
    sentence = "Бер өй бар иде. "
    text = sentence * 60
    for begin, start, end in split.pieces(text):
        assert start == 0 or text[:start].endswith(". ")
        assert begin == start or text[begin - 1].isspace()
    assert len(split.pieces("x" * 1201)) == 4


def test_split_in_spark(spark):
    rows = [(1, "a" * 500), (2, "a " * 300), (3, None), (4, ""), (5, "\U0001f642" * 500), (6, "\U0001f642" * 501), (2, "a " * 300)]
    df = spark.createDataFrame(rows, "seq long, text string")
    got = split.split_oversized(df, "text", ["seq"]).collect()
    assert {r.seq for r in got} == {2, 6} and max(len(r.piece) for r in got) <= 500
    assert sum(r.n_pieces for r in got if r.piece_no == 0 and r.seq == 2) == sum(1 for r in got if r.seq == 2)
    assert split.split_oversized(df.limit(0), "text", ["seq"]).count() == 0
    with pytest.raises(ValueError):
        split.split_oversized(df.withColumnRenamed("seq", "piece_no"), "text", ["piece_no"])


# ---- p7


@pytest.fixture(scope="module")
def encoder():
    return tokenize.load_encoder(f"{tokenize.tokenizer_dir()}/byte_bpe_50k.tiktoken")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\u3000\xa0абAb1٢'s.!<|endoftext>\U0001f642\u0301\r\x85é_-"), max_size=300), max_size=6))
def test_chunks_give_the_tokens_of_the_whole(encoder, texts):
    assert tokenize.ChunkEncoder(encoder.encode_ordinary, 50).texts(texts) == [encoder.encode_ordinary(t) for t in texts]


def test_encoding_of_documents(spark, encoder):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{tokenize.tokenizer_dir()}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = by_key(tokenize.encode_corpus(docs, "doc_id", "text", f"{tokenize.tokenizer_dir()}/byte_bpe_50k.tiktoken"), "doc_id", "ids")
    texts = by_key(docs, "doc_id", "text")
    keys = sorted(texts)
    want = [e.ids for e in other.encode_batch([texts[k] or "" for k in keys], add_special_tokens=False)]
    assert [got[k] for k in keys] == want
    assert encoder.decode(got[keys[0]]) == texts[keys[0]]


def test_encoding_of_nothing(spark):
    path = f"{tokenize.tokenizer_dir()}/byte_bpe_50k.tiktoken"
    df = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "<|endoftext|>"), (4, "я" * 300_000)], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = tokenize.encode_corpus(df, "doc_id", "text", path).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in got)[:3] == [(1, 0), (2, 0), (2, 0)] and len(got) == 5
    assert 50256 not in next(r.ids for r in got if r.doc_id == 3)
    assert tokenize.encode_corpus(df.limit(0), "doc_id", "text", path).count() == 0


# ---- p8


def plain_leaks(doc, items, least):
    words, out = leak.words_of(doc), {}
    for item, text in items:
        w = leak.words_of(text)
        best = 0
        for i in range(len(words)):
            for j in range(len(w)):
                n = 0
                while i + n < len(words) and j + n < len(w) and words[i + n] == w[j + n]:
                    n += 1
                best = max(best, n)
        if best >= least:
            out[item] = best
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=25), st.integers(1, 4))
def test_automaton(items, doc, least):
    items = [(i, " ".join(w)) for i, w in enumerate(items)]
    auto = leak.ItemAutomaton([(i, leak.words_of(t)) for i, t in items], least)
    got = auto.matches(leak.words_of(" ".join(doc)))
    assert {item: n for item, _, n in got} == plain_leaks(" ".join(doc), items, least)
    for item, first, n in got:
        assert " ".join(doc[first : first + n]) in dict(items)[item]


def test_leaks_in_spark(spark):
    passage = "бер ике өч дүрт биш алты җиде сигез тугыз ун унбер"
    noisy = "БЕР, икe  өч\u200b дүрт\nбиш! aлты җиде: сигез тугыз ун ун\u00adбер"
    rows = [(1, f"башы {passage} ахыры"), (2, None), (3, ""), (4, "бер ике өч дүрт биш алты җиде сигез тугыз"), (5, f"сүз {noisy} сүз"), (1, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(7, passage), (8, None), (9, ""), (10, "кыска"), (11, passage + " тагын")], "item_id long, text string")
    got = leak.find_leaks(docs, "doc_id", "text", items, "item_id", "text", materialise).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 7), (1, 7), (1, 11), (1, 11), (5, 7), (5, 11)]
    first = next(r for r in got if r.doc_id == 1 and r.doc_words == 13)
    assert rows[0][1][first.char_start : first.char_end] == passage
    cleaned = by_key(leak.without_leaks(docs.where("doc_id > 1"), "doc_id", "text", leak.find_leaks(docs.where("doc_id > 1"), "doc_id", "text", items, "item_id", "text", materialise), max_coverage=0.9), "doc_id", "text", "leak_action")
    assert cleaned[5] == ("сүз  сүз", "cut") and cleaned[2] == (None, "kept") and cleaned[4][1] == "kept"
    assert leak.find_leaks(docs, "doc_id", "text", items.limit(0), "item_id", "text", materialise).count() == 0
    assert leak.find_leaks(docs.limit(0), "doc_id", "text", items, "item_id", "text", materialise).count() == 0


def plain_runs(words, items, least):
    """Every (item, first, count) that is in the item and, prolonged by a word on either side, isn't."""
    out = set()
    for item, w in items:
        inside = {tuple(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        for i in range(len(words)):
            for j in range(i + least, len(words) + 1):
                longer = (i and tuple(words[i - 1 : j]) in inside) or (j < len(words) and tuple(words[i : j + 1]) in inside)
                if tuple(words[i:j]) in inside and not longer:
                    out.add((item, i, j - i))
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=25), st.integers(1, 4))
def test_automaton_runs(items, doc, least):
    items, doc = [(i, leak.words_of(" ".join(w))) for i, w in enumerate(items)], leak.words_of(" ".join(doc))
    assert leak.ItemAutomaton(items, least).runs(doc) == plain_runs(doc, items, least)


def test_every_leaked_passage_goes(spark):
    """Two passages of one item, one of them twice, in documents of different length."""
    item = [f"сүз{n}" for n in range(40)]
    one, two = " ".join(item[:12]), " ".join(item[20:32])
    rest = [" ".join(f"{at}х{n}" for n in range(15)) for at in "абвг"]
    rows = [(1, f"{rest[0]} {one} {rest[1]} {two} {rest[2]} {one} {rest[3]}"), (2, f"{rest[0]} {one} башка {two}")]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    leaks = leak.find_leaks(docs, "doc_id", "text", items, "item_id", "text", materialise)
    got = sorted((r.doc_id, r.first_word, r.n_words, r.item_covered, r.item_words) for r in leaks.collect())
    assert got == [(1, 15, 12, 24, 40), (1, 42, 12, 24, 40), (1, 69, 12, 24, 40), (2, 15, 12, 24, 40), (2, 28, 12, 24, 40)]
    cleaned = leak.without_leaks(docs, "doc_id", "text", leaks)
    assert by_key(cleaned, "doc_id", "text", "leak_action") == {1: ("  ".join(rest), "cut"), 2: (None, "dropped")}
    assert leak.find_leaks(cleaned, "doc_id", "text", items, "item_id", "text", materialise).count() == 0
    once = leak.find_leaks(docs, "doc_id", "text", items, "item_id", "text", materialise, longest=True).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word) for r in once) == [(1, 7, 15), (2, 7, 15)]


# ---- p9


def test_levels_held_out(spark):
    graded = spark.read.parquet(f"{DATA}/level_samples.parquet")
    train, test = graded.where("sample_id % 3 <> 0"), graded.where("sample_id % 3 = 0").withColumnRenamed("level", "given")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(F.col("doc_id").alias("sample_id"), "text")
    both = docs.select((F.col("sample_id") + 1000).alias("sample_id"), "text").unionByName(test.select("sample_id", "text"))
    got = level.grade_texts(both, "sample_id", "text", train, "text", "level").join(test, "sample_id").toPandas()
    assert (got.level == got.given).mean() > 0.9
    assert ((got.level == 3) == (got.given == 3)).mean() > 0.93


def test_level_cases(spark):
    graded = spark.createDataFrame([("бер ике өч.", 1), ("мөмкинчелекләр нәтиҗәлелек югарыда әйтелгәнчә.", 3), (None, 2), ("x", None)], "text string, level int")
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "бер ике өч."), (4, "бер ике өч."), (5, "сүз " * 20_000)]
    df = spark.createDataFrame(rows, "k long, t string").withColumn("level", F.lit("clash"))
    got = level.grade_texts(df, "k", "t", graded, "text", "level").collect()
    assert len(got) == 6 and all(r.level is None for r in got if r.k < 4) and all(r.level in (1, 3) for r in got if r.k >= 4)
    assert level.grade_texts(df.limit(0), "k", "t", graded, "text", "level").count() == 0
    assert all(r.level is None for r in level.grade_texts(df, "k", "t", graded.limit(0), "text", "level").collect())


def test_diversity_reads_the_last_words():
    """Texts of one sentence whose first 40 words are alike and whose last ones repeat, or don't."""
    words = [f"сүз{'абвгдеж'[n % 7]}{'клмнопр'[n // 7 % 7]}{'стуф'[n // 49]}" for n in range(79)]
    texts = [" ".join(w) for w in (words[:40], words, words[:40] + [words[40]] * 39, words[:40] + words[:1], words[:20])]
    found = level.Describer(np.ones(1 << 20)).texts(texts)[0][:, -1]
    assert found[0] == found[1] == found[4] and found[2] < found[1]
    assert np.isclose(found[2], ((1 + 2 / 40) / 2 - 0.9) / 0.1) and found[3] == found[0]


def test_one_odd_sentence_moves_nothing(spark):
    graded = spark.read.parquet(f"{DATA}/level_samples.parquet")
    rows = {r.sample_id: r for r in graded.collect()}
    hard = next(r.text for r in rows.values() if r.level == 3 and r.lang == "tt").split(". ")[0].split("… ")[0]
    easy = [r for r in rows.values() if r.level == 1 and r.lang == "tt"][1]
    docs = spark.createDataFrame([(1, easy.text), (2, f"{easy.text} {hard}.")], "k long, t string")
    got = by_key(level.grade_texts(docs, "k", "t", graded, "text", "level"), "k", "level")
    assert got == {1: 1, 2: 1}


def test_shards_of_items(spark, monkeypatch):
    """Items in many automata, one after another, give the rows of one automaton; rows of one id stay together."""
    rng = random.Random(3)
    items = [(i // 2, " ".join(f"w{rng.randrange(300)}" for _ in range(20))) for i in range(24)]
    docs = [(d, " ".join(" ".join(rng.choice(items)[1].split()[rng.randrange(6) :]) for _ in range(3))) for d in range(40)]
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (None, items[0][1])], "item_id long, text string")]
    whole = {tuple(r) for r in leak.find_leaks(frames[0], "doc_id", "text", frames[1], "item_id", "text", materialise, longest=True).collect()}
    monkeypatch.setattr(leak, "SHARD_CHARS", 200)
    assert len(list(leak._shards(items))) == 12
    rows = [tuple(r) for r in leak.find_leaks(frames[0], "doc_id", "text", frames[1], "item_id", "text", materialise, longest=True).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == whole and len({r[:2] for r in rows}) == len(rows)


def test_kinds_of_abuse():
    """Kinds go by whole beginnings of words, and the links agree on sentences they weren't fitted on."""
    cues = {
        "you are an idiot": "insult", "everybody here is a moron": "insult", "your mother is ugly": "insult", "i will find you and break your legs": "threat", "send naked photos": "sexual",
        "they are not people": "incitement", "ты полный кретин": "insult", "скинь голые фото": "sexual", "они не люди, их надо уничтожить": "incitement", "сен нағыз ақымақсың": "insult",
    }
    assert {s: toxicity.kind_by_cue(toxicity.sentence_words(s)[0]) for s in cues} == cues


def test_chain_kinds(spark):
    from textloom.llm.queries import _toxicity_chain

    chain = _toxicity_chain(spark, "/root/testdata/sf0.1")
    wanted = {"кичкә аякларыңны сындырам": "threat", "ялангач фотоңны җибәр": "sexual", "алар кеше түгел, аларны бетерергә кирәк": "incitement", "син ахмак": "insult", "you are an idiot": "insult", "я тебя найду и убью": "threat", "hang yourself": "threat"}
    scores = toxicity.score_segments(list(wanted), chain, toxicity.Features())
    assert [chain.names[k] for k in scores[:, :4].argmax(1)] == list(wanted.values()) and (scores[:, -1] >= toxicity.THRESHOLD).all()


def test_ligatures_and_members(spark):
    assert looks.settle("ﬁne ﬂow oﬃce") == "fine flow office"
    texts = ["салам дус", "caлам дус", "салам дус", "башка", None, "салам\u200b дус"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    got = {r.key: (r.first, r.n_rows, r.n_texts, r.n_links) for r in looks.same_look_members(df, "seq", "text", materialise).collect()}
    assert got == {0: (0, 4, 3, 2), 1: (0, 4, 3, 3), 2: (0, 4, 3, 2), 3: (3, 1, 1, 0), 5: (0, 4, 3, 3)}
