"""The pN_ queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans.shared import expire, materialise, spread, temporary_folder
from textloom.sources.tables import read_table

from . import history, language, leak, level, looks, neardup, split, tokenize, toxicity


def _toxicity_chain(spark: SparkSession, folder: str) -> toxicity.Chain:
    return toxicity.fit(read_table(spark, folder, "toxicity_segments"), "id", "text", read_table(spark, folder, "toxicity_reviews"), "id", "abusive")


def p1_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of toxicity_segments with its own score and category, beside the given label and score."""
    return toxicity.score(spread(read_table(spark, folder, "toxicity_segments")), ["seq", "id", "parent_digest", "toxicity_label", "toxicity_score"], "text", _toxicity_chain(spark, folder))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(spread(read_table(spark, folder, "toxicity_segments")), ["id"], "text", _toxicity_chain(spark, folder))
    return scored.where(F.col("toxicity") >= toxicity.THRESHOLD).select("id").distinct()


def p1_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Per community: segments, abusive ones and their rate; segments of no known community are under null.

    A segment that was scored twice counts once, by its higher score.
    """
    scored = toxicity.score(spread(read_table(spark, folder, "toxicity_segments")), ["id", "parent_digest"], "text", _toxicity_chain(spark, folder))
    segments = scored.groupBy("id", "parent_digest").agg(F.max("toxicity").alias("toxicity"))
    source = F.coalesce(F.nullif("url", F.lit("")), F.nullif("message_url", F.lit("")))
    communities = (
        read_table(spark, folder, "raw_messages").where(source.isNotNull())
        .select(F.sha1(source).alias("parent_digest"), "community").groupBy("parent_digest").agg(F.min("community").alias("community"))
    )
    # Segments of one message are summed before the join, so a busy source doesn't make a hot key.
    by_source = segments.groupBy("parent_digest").agg(F.count("*").alias("n"), F.count_if(F.col("toxicity") >= toxicity.THRESHOLD).alias("bad"))
    return by_source.join(communities, "parent_digest", "left").groupBy("community").agg(
        F.sum("n").alias("n_segments"), F.sum("bad").alias("n_abusive"), (F.sum("bad") / F.sum("n")).alias("abusive_rate")
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = looks.same_look_pairs(spread(read_table(spark, folder, "clean_segments").select("seq", "text")), "seq", "text", materialise)
    return pairs.select(F.col("key_a").alias("seq_a"), F.col("key_b").alias("seq_b"))


def p2_members(spark: SparkSession, folder: str) -> DataFrame:
    """The look of every clean segment, named by its first one, with how many segments and texts have it."""
    return looks.same_look_members(spread(read_table(spark, folder, "clean_segments").select("seq", "text")), "seq", "text", materialise).withColumnsRenamed({"key": "seq", "first": "first_seq"})


def p2_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every clean segment in its consistent form."""
    forms = looks.consistent_form(spread(read_table(spark, folder, "clean_segments").select("seq", "text")), "seq", "text", materialise)
    return forms.select(F.col("key").alias("seq"), F.col("form").alias("text"))


def _history(spark: SparkSession, folder: str) -> tuple[history.FingerprintStore, history.KeyLog]:
    """The store of accepted texts and the log of row hashes.

    With ``textloom.history`` set in the session they stand in that folder from one run to the
    next, and only batches that aren't there yet are added. Without it they are made of
    dedup_segments and ingest_log in the shared folder, and removed with the session.
    """
    at = spark.conf.get("textloom.history", None)
    if at is None:
        at = temporary_folder(spark, "history")
        expire(spark, at)
    log = history.KeyLog(spark, f"{at}/log")
    log.add(read_table(spark, folder, "ingest_log"), "row_hash", 0)
    if history.FingerprintStore.there(spark, f"{at}/texts"):
        return history.FingerprintStore(spark, f"{at}/texts"), log
    accepted = history.text_sets(spread(read_table(spark, folder, "dedup_segments").select("seq", "text")), "seq", "text").select("class", "words")
    return history.FingerprintStore.create(materialise(accepted, "accepted"), f"{at}/texts"), log


def _incoming_checked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Incoming rows, and the (batch_no, seq) of those known by row hash, from the store, and from an earlier row of their batch.

    Batch by batch: its rows are looked up, and then added, so the next batch meets them in the store.
    """
    rows = read_table(spark, folder, "incoming_segments").withColumn("place", F.struct("batch_no", "seq"))
    store, log = _history(spark, folder)
    logged = rows.join(log.known(rows, "row_hash").withColumnRenamed("key", "row_hash"), "row_hash", "left_semi").select("place")
    stored = earlier = None
    # A row without a batch number is of no batch: it is checked last, and not added. Generation 0 is what was there before.
    for r in rows.select("batch_no").distinct().orderBy(F.col("batch_no").asc_nulls_last()).collect():
        batch = rows.where(F.col("batch_no").eqNullSafe(F.lit(r.batch_no)))
        number = None if r.batch_no is None else r.batch_no + 1
        found = history.check_and_add(store, history.text_sets(batch, "place", "text"), number, materialise)
        found = [f.withColumnRenamed("key", "place") for f in found]
        stored, earlier = found if stored is None else (stored.unionByName(found[0]), earlier.unionByName(found[1]))
    none = rows.select("place").limit(0)
    return rows, logged, none if stored is None else stored, none if earlier is None else earlier


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    _, *known = _incoming_checked(spark, folder)
    return known[0].unionByName(known[1]).unionByName(known[2]).select("place.seq").distinct()


def p3_status(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each incoming row is new, and if not, by what it is known: its row hash, the store, or an earlier row of its batch."""
    rows, *known = _incoming_checked(spark, folder)
    names = ("by_row_hash", "by_store", "by_batch")
    marks = reduce(DataFrame.unionByName, (places.select("place", F.lit(name).alias("by")) for name, places in zip(names, known)))
    marks = marks.groupBy("place").agg(*(F.max(F.col("by") == n).alias(n) for n in names))
    flags = [F.coalesce(n, F.lit(False)).alias(n) for n in names]
    status = F.when(F.col("by_row_hash").isNull(), "new").otherwise("known").alias("status")
    return rows.select("seq", "batch_no", "place").join(marks, "place", "left").select("seq", "batch_no", status, *flags)


def _language_models(spark: SparkSession, folder: str) -> language.LanguageModels:
    """Fitted on the texts of known language: level_samples and eval_items."""
    known = read_table(spark, folder, "level_samples").select("lang", "text").unionByName(read_table(spark, folder, "eval_items").select("lang", "text"))
    return language.fit(spark, known, "lang", "text")


def p4_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, with confidence and shares, beside its given label."""
    return language.label_languages(spread(read_table(spark, folder, "documents")), ["doc_id", "lang"], "text", _language_models(spark, folder))


def p4_spans(spark: SparkSession, folder: str) -> DataFrame:
    """The spans of each language in every document that mixes some."""
    return language.language_spans(spread(read_table(spark, folder, "documents")), "doc_id", "text", _language_models(spark, folder))


def p4_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every row of llm_segments, beside the one its payload gives."""
    return language.payload_languages(spread(read_table(spark, folder, "llm_segments")), "id", "gemini_json", "text", _language_models(spark, folder))


def p4_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Corrected main_language, tatar_prob and russian_share of every id of label_payload, beside the given ones."""
    models = _language_models(spark, folder)
    texts = read_table(spark, folder, "llm_segments").groupBy("id").agg(F.min("text").alias("text"))
    given = read_table(spark, folder, "label_payload").select("id", F.col("main_language").alias("given_language"), F.col("tatar_prob").alias("given_tatar_prob"), F.col("russian_share").alias("given_russian_share"))
    labelled = language.label_languages(texts, ["id"], "text", models, language.segment_language)
    return given.join(labelled.select("id", F.col("language").alias("main_language"), F.col("tt").alias("tatar_prob"), F.col("ru").alias("russian_share"), "confidence"), "id", "left")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    models = _language_models(spark, folder)
    documents = language.label_languages(spread(read_table(spark, folder, "documents")), ["doc_id", "lang"], "text", models)
    wrong = documents.where("language IS NOT NULL AND lower(trim(coalesce(lang, ''))) <> language").select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("item_key"), "language"
    )
    segments = language.payload_languages(spread(read_table(spark, folder, "llm_segments")), "id", "gemini_json", "text", models)
    bad = segments.where("language IS NOT NULL AND coalesce(given, '') <> language").groupBy("id").agg(F.min("language").alias("language"))
    return wrong.unionByName(bad.select(F.lit("segment").alias("kind"), F.col("id").alias("item_key"), "language"))


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every oversized clean segment, traceable by id and parent_digest."""
    return split.split_oversized(spread(read_table(spark, folder, "clean_segments")), "text", ["seq", "id", "parent_digest"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_pieces(spark, folder).where("piece_no = 0").select("seq")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = neardup.like_pairs(spread(read_table(spark, folder, "dedup_segments").select("seq", "text")), "seq", "text", materialise)
    return pairs.select(F.col("key_a").alias("seq_a"), F.col("key_b").alias("seq_b"))


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The group of alike segments of every dedup segment, and how many it is like."""
    found = neardup.groups(spread(read_table(spark, folder, "dedup_segments").select("seq", "text")), "seq", "text", materialise)
    return found.select(F.col("key").alias("seq"), F.col("group").alias("group_seq"), "group_size", "n_links")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = f"{tokenize.tokenizer_dir()}/byte_bpe_50k.tiktoken"
    return tokenize.encode_corpus(spread(read_table(spark, folder, "documents")), "doc_id", "text", vocabulary)


def p8_leaks(spark: SparkSession, folder: str, longest: bool = False) -> DataFrame:
    """Every passage that a document and an evaluation item share, with its span."""
    return leak.find_leaks(spread(read_table(spark, folder, "documents").select("doc_id", "text")), "doc_id", "text", read_table(spark, folder, "eval_items"), "item_id", "text", materialise, longest=longest)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_leaks(spark, folder, longest=True).select("doc_id", "item_id")


def p8_items(spark: SparkSession, folder: str) -> DataFrame:
    """Which items leaked, into how many documents, and how much of them at most."""
    return p8_leaks(spark, folder).groupBy("item_id").agg(
        F.count_distinct("doc_id").alias("n_docs"), F.max("n_words").alias("longest_run"), F.max(F.col("item_covered") / F.col("item_words")).alias("coverage")
    )


def p8_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without their leaked spans."""
    return leak.without_leaks(read_table(spark, folder, "documents"), "doc_id", "text", p8_leaks(spark, folder))


def p9_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The reading level of every document, on the scale of level_samples."""
    return level.grade_texts(spread(read_table(spark, folder, "documents")), "doc_id", "text", read_table(spark, folder, "level_samples"), "text", "level")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_levels(spark, folder).where("level = 3").select("doc_id")


def p9_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How demanding each source's documents are; a null source is a source of its own."""
    sources = read_table(spark, folder, "documents").select("doc_id", "source")
    return p9_levels(spark, folder).join(sources, "doc_id").groupBy("source").agg(
        F.count("level").alias("n_graded"), F.avg("level_score").alias("mean_level"), F.avg((F.col("level") == 3).cast("double")).alias("share_demanding")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_scores": p1_scores,
    "p1_rates": p1_rates,
    "p2_found": p2_found,
    "p2_forms": p2_forms,
    "p2_members": p2_members,
    "p3_found": p3_found,
    "p3_status": p3_status,
    "p4_found": p4_found,
    "p4_documents": p4_documents,
    "p4_spans": p4_spans,
    "p4_segments": p4_segments,
    "p4_payload": p4_payload,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p6_found": p6_found,
    "p6_groups": p6_groups,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p8_items": p8_items,
    "p8_cleaned": p8_cleaned,
    "p9_found": p9_found,
    "p9_levels": p9_levels,
    "p9_sources": p9_sources,
}

# ---- SQL, by all pairs of word sets and all runs of ten words ---------------------


def _like_sql(one: str, two: str) -> str:
    """a, b: alike rows of two tables (row, text), by the distinct words both have; texts without words are alike if they are equal."""
    words = r"list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))"
    return f"""one AS MATERIALIZED (SELECT row, text, {words} AS words FROM ({one}) WHERE text IS NOT NULL),
    two AS MATERIALIZED (SELECT row, text, {words} AS words FROM ({two}) WHERE text IS NOT NULL),
    shared AS (SELECT a.row AS a, b.row AS b, count(*) AS n FROM (SELECT row, unnest(words) AS w FROM one) a JOIN (SELECT row, unnest(words) AS w FROM two) b USING (w) GROUP BY a.row, b.row),
    alike AS (SELECT a, b FROM shared JOIN one ON one.row = a JOIN two ON two.row = b WHERE n * 5 >= (len(one.words) + len(two.words) - n) * 3
        UNION ALL SELECT one.row, two.row FROM one JOIN two USING (text) WHERE len(one.words) = 0)"""


_DEDUP = "SELECT seq AS row, text FROM dedup_segments"
_P3_ALIKE = f"""WITH {_like_sql("SELECT struct_pack(b := batch_no, s := seq) AS row, text FROM incoming_segments",
    "SELECT struct_pack(b := -1, s := seq) AS row, text FROM dedup_segments UNION ALL SELECT struct_pack(b := batch_no, s := seq), text FROM incoming_segments")}"""
_P3 = f"""{_P3_ALIKE}
    SELECT seq FROM incoming_segments WHERE row_hash IN (SELECT row_hash FROM ingest_log) UNION SELECT a.s FROM alike WHERE b.b < a.b OR (b.b = a.b AND b.s < a.s)"""
_P3_STATUS = f"""{_P3_ALIKE},
    marked AS (SELECT seq, batch_no, coalesce(row_hash IN (SELECT row_hash FROM ingest_log WHERE row_hash IS NOT NULL), false) AS by_row_hash,
        seq IN (SELECT a.s FROM alike WHERE b.b < a.b) AS by_store, seq IN (SELECT a.s FROM alike WHERE b.b = a.b AND b.s < a.s) AS by_batch FROM incoming_segments)
    SELECT seq, batch_no, CASE WHEN by_row_hash OR by_store OR by_batch THEN 'known' ELSE 'new' END AS status, by_row_hash, by_store, by_batch FROM marked"""
_P6 = f"WITH {_like_sql(_DEDUP, _DEDUP)} SELECT a AS seq_a, b AS seq_b FROM alike WHERE a < b AND len((SELECT words FROM one WHERE one.row = a)) > 0"
_P6_GROUPS = f"""WITH RECURSIVE {_like_sql(_DEDUP, _DEDUP)},
    class AS MATERIALIZED (SELECT row, min(row) OVER (PARTITION BY list_sort(words)) AS class FROM one WHERE len(words) > 0),
    edges AS MATERIALIZED (SELECT DISTINCT a, b FROM alike JOIN class x ON x.row = a AND x.class = a JOIN class y ON y.row = b AND y.class = b),
    reach AS (SELECT class AS root, class AS node FROM class UNION SELECT r.root, e.b FROM reach r JOIN edges e ON e.a = r.node),
    least AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
    degree AS (SELECT a, count(*) - 1 AS n FROM edges GROUP BY a),
    found AS (SELECT c.row, l.root, coalesce(d.n, 0) AS n FROM class c JOIN least l ON l.node = c.class LEFT JOIN degree d ON d.a = c.class)
    SELECT t.seq, coalesce(f.root, t.seq) AS group_seq, coalesce(count(*) OVER (PARTITION BY f.root), 1) * (f.root IS NOT NULL)::INT + (f.root IS NULL)::INT AS group_size, coalesce(f.n, 0) AS n_links
    FROM dedup_segments t LEFT JOIN found f ON f.row = t.seq"""


def _leak_words_sql() -> str:
    """The words of a text in the form in which leaks compare them."""
    narrow = "".join(chr(c) for c in range(0x21, 0x7F))
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    fold = {k: v for k, v in leak._FOLD.items()}
    letters, by = "".join(map(chr, fold)), "".join(v if isinstance(v, str) else chr(v) for v in fold.values())
    plain = f"nfc_normalize(translate(regexp_replace(text, '{leak._DROP.pattern}', '', 'g'), '{wide}', '{narrow.replace(chr(39), chr(39) * 2)}'))"
    return rf"regexp_extract_all(translate(lower({plain}), '{letters}', '{by}'), '[\p{{L}}\p{{N}}]+')"


_P8 = f"""WITH items AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 8), lambda k: list_aggregate(w[k:k + 9], 'string_agg', ' '))) AS gram FROM (SELECT item_id, {_leak_words_sql()} AS w FROM eval_items)),
    docs AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 8), lambda k: list_aggregate(w[k:k + 9], 'string_agg', ' '))) AS gram FROM (SELECT doc_id, {_leak_words_sql()} AS w FROM documents WHERE text IS NOT NULL))
    SELECT DISTINCT doc_id, item_id FROM docs JOIN items USING (gram)"""

SQL: dict[str, str] = {
    "p3_found": _P3,
    "p3_status": _P3_STATUS,
    "p5_found": "SELECT seq FROM clean_segments WHERE length(text) > 500",
    "p6_found": _P6,
    "p6_groups": _P6_GROUPS,
    "p8_found": _P8,
}
