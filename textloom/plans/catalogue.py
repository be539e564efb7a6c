"""The queries of the curation operators, each over its whole tables, and the SQL that gives the same rows.

The SQL is written from the rules, not from the Spark code: greedy steps as recursive
queries that go row by row, packing as a fold, XXH32 by its definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.labels import FIELDS, NUMBERS, WORDS, any_labels, flat_labels
from textloom.functions.privacy import anonymise
from textloom.functions.simhash import hamming
from textloom.operators import dedup, export, firstwins, membership, scoring, segment, selection
from textloom.plans.shared import materialise, spread
from textloom.profile import DEFAULT
from textloom.sources.messages import resolved
from textloom.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is some."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose texts are worked on, spread over all cores where one small file holds it."""
    return spread(read_table(spark, folder, name))


# ---- SQL pieces ----------------------------------------------------------------

_LOWER_WORDS = f"regexp_extract_all(lower(text), '{T.WORD.replace(chr(39), chr(39) * 2)}')"
_INNER_SPACE = T.SPACE.replace(r"\x{9}-\x{d}", r"\x{9}\x{b}-\x{d}")


def _strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{T.SPACE}]+|[{T.SPACE}]+\z', '', 'g')"


_RAW = "coalesce(nullif(text, ''), nullif(message, ''), '')"
_SOURCE = "coalesce(nullif(url, ''), nullif(message_url, ''), 'url:' || seq)"


def _regular_sql(x: str) -> str:
    return (
        rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '[\x{{d}}\x{{200b}}\x{{feff}}\x{{2060}}]', '', 'g'), "
        rf"'{T.LINE_BREAK}', chr(10), 'g'), '\n\z', ''), '[ \x{{9}}\x{{a0}}]+', ' ', 'g'), '(?m)^[{_INNER_SPACE}]+|[{_INNER_SPACE}]+$', '', 'g')"
    )


_NORMAL = _regular_sql(_RAW)
_CONTACT = rf"(?i){T.WORD_START}{T.URL}|{T.EMAIL}|{T.PHONE}"


def _contact_only_sql(x: str) -> str:
    return rf"(regexp_replace(regexp_replace({x}, '{_CONTACT}', ' ', 'g'), '[\p{{P}}\p{{S}}{T.SPACE}]+', '', 'g') = '')"


_SCRIPT = r"len(regexp_extract_all(text, '\p{Cyrillic}'))"
_REASON = f"""CASE
    WHEN {_SCRIPT} < 10 THEN 'min_letters'
    WHEN len(regexp_extract_all(text, '[{DEFAULT.marker_letters}]')) < 6 THEN 'min_tatar_letters'
    WHEN len({_LOWER_WORDS}) < 6 THEN 'min_words'
    WHEN len({_LOWER_WORDS}) > 50 THEN 'max_words'
    WHEN length(text) < 30 THEN 'min_chars'
    WHEN length(text) > 500 THEN 'max_chars'
    WHEN regexp_matches(text, '{T.SINGLE_BRACKET}') THEN 'single_bracket_placeholder'
    ELSE 'pass' END"""


def _simhash_sql(table: str) -> str:
    bits = ", ".join(f"sum((h{half} >> {i}) & 1) AS {half}{i}" for half in ("hi", "lo") for i in range(32))
    pack = {half: " + ".join(f"(CASE WHEN {half}{i} * 2 > n THEN {1 << i} ELSE 0 END)" for i in range(32)) for half in ("hi", "lo")}
    return f"""words AS (SELECT seq, unnest({_LOWER_WORDS}) AS w FROM {table}),
hashes AS (SELECT seq, ('0x' || substr(md5(w), 17, 8))::BIGINT AS hhi, ('0x' || substr(md5(w), 25, 8))::BIGINT AS hlo FROM words),
sums AS (SELECT seq, count(*) AS n, {bits} FROM hashes GROUP BY seq),
simhashes AS (SELECT t.seq, coalesce(CAST({pack['hi']} AS BIGINT), 0) AS simhash_hi, coalesce(CAST({pack['lo']} AS BIGINT), 0) AS simhash_lo
    FROM {table} t LEFT JOIN sums USING (seq) WHERE t.text IS NOT NULL)"""


def _labels_sql(kind: str) -> str:
    def read(at: str) -> tuple[str, str]:
        good = [f"json_type(j, '{at}.{f}') = 'VARCHAR'" for f in WORDS] + [f"try_cast(json_extract_string(j, '{at}.{f}') AS DOUBLE) IS NOT NULL" for f in NUMBERS]
        fields = ", ".join(f"{f} := " + (f"json_extract_string(j, '{at}.{f}')" if f in WORDS else f"try_cast(json_extract_string(j, '{at}.{f}') AS DOUBLE)") for f in FIELDS)
        return " AND ".join(good), f"struct_pack({fields})"

    flat, wrapped = read("$"), read("$.labels")
    other = f" WHEN {wrapped[0]} THEN {wrapped[1]}" if kind == "any" else ""
    return f"""parsed AS (SELECT *, CASE WHEN json_valid(gemini_json) THEN gemini_json::JSON END AS j FROM llm_segments),
labelled AS (SELECT *, CASE WHEN {flat[0]} THEN {flat[1]}{other} END AS l FROM parsed)"""


_CANDIDATES = f"""{_labels_sql('flat')},
candidates AS (SELECT id, text, l.error_density AS density,
    0.50 * l.overall_gec_usefulness + 0.20 * l.meaning_clarity + 0.15 * l.tatar_prob + 0.10 * l.error_share + 0.05 * l.non_fluent_prob - 0.20 * l.noise_score AS score
    FROM labelled WHERE l IS NOT NULL AND coalesce(toxicity_label, 0) = 0
    AND l.main_language IN ('tatar', 'mixed') AND l.error_density IN ('low', 'medium', 'high')
    AND (isnan(l.noise_score) OR l.noise_score <= 0.35) AND (isnan(l.meaning_clarity) OR l.meaning_clarity >= 0.35)
    AND (isnan(l.overall_gec_usefulness) OR l.overall_gec_usefulness >= 0.4)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY density ORDER BY score DESC, id, text) AS bucket_rank FROM candidates),
sizes AS (SELECT count(*) FILTER (density = 'low') AS low, count(*) FILTER (density = 'medium') AS medium, count(*) FILTER (density = 'high') AS high FROM candidates)"""


def _selection_sql(limit: int, share: float, keep: bool) -> str:
    free = "" if keep else """,
    filled AS (SELECT medium, low + least(all_low - low, (rest + 1) // 2) AS low, high, all_high, rest, least(all_low - low, (rest + 1) // 2) AS more FROM first),
    quota AS (SELECT medium, low, high + least(all_high - high, rest - more) AS high FROM filled)"""
    return f"""WITH {_CANDIDATES},
    wanted AS (SELECT *, CAST(round_even({limit} * {share}, 0) AS BIGINT) AS w FROM sizes),
    ends AS (SELECT least(low, w) AS l, least(high, w) AS h, * FROM wanted),
    first AS (SELECT l AS low, h AS high, low AS all_low, high AS all_high, least(medium, greatest(0, {limit} - l - h)) AS medium,
        greatest(0, {limit} - l - h) - least(medium, greatest(0, {limit} - l - h)) AS rest FROM ends){free or ', quota AS (SELECT medium, low, high FROM first)'}
    SELECT id, density, bucket_rank FROM (
        SELECT r.*, CASE density WHEN 'medium' THEN 0 WHEN 'low' THEN q.medium ELSE q.medium + q.low END + bucket_rank AS place,
            CASE density WHEN 'medium' THEN q.medium WHEN 'low' THEN q.low ELSE q.high END AS most FROM ranked r, quota q)
    WHERE bucket_rank <= most AND place <= {limit}"""


def _greedy_sql(table: str, near: str, norms: bool) -> str:
    """First come, first kept, row by row in order: a row with a kept earlier neighbour goes. Only rows that have neighbours are gone through."""
    same = f"UNION SELECT a.seq, b.seq FROM {table} a JOIN {table} b ON a.norm_hash = b.norm_hash AND a.seq < b.seq" if norms else ""
    exact = "WHEN list_has_any(kept.seqs, same.before) THEN 'exact_dup'" if norms else ""
    return f"""WITH RECURSIVE {_simhash_sql(table)},
    hashed AS MATERIALIZED (SELECT s.*, len({_LOWER_WORDS}) AS n_tokens FROM simhashes s JOIN {table} USING (seq)),
    edges AS MATERIALIZED (SELECT a.seq AS earlier, b.seq AS later FROM hashed a JOIN hashed b
        ON a.seq < b.seq AND bit_count(xor(a.simhash_hi, b.simhash_hi)) + bit_count(xor(a.simhash_lo, b.simhash_lo)) <= {near} {same}),
    queue AS MATERIALIZED (SELECT seq, list(earlier) FILTER (earlier IS NOT NULL) AS before, row_number() OVER (ORDER BY seq) AS k FROM (
        SELECT later AS seq, earlier FROM edges UNION SELECT earlier, NULL FROM edges) GROUP BY seq),
    walk AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS seqs UNION ALL
        SELECT q.k, CASE WHEN coalesce(list_has_any(w.seqs, q.before), false) THEN w.seqs ELSE list_append(w.seqs, q.seq) END FROM walk w JOIN queue q ON q.k = w.k + 1),
    kept AS (SELECT seqs FROM walk ORDER BY k DESC LIMIT 1),
    same AS (SELECT b.seq, list(a.seq) AS before FROM {table} a JOIN {table} b ON {'a.norm_hash = b.norm_hash AND a.seq < b.seq' if norms else 'false'} GROUP BY b.seq)
    SELECT t.seq, CASE WHEN q.seq IS NULL OR list_contains(kept.seqs, t.seq) THEN 'kept' {exact} ELSE 'near_dup' END AS status
    FROM {table} t CROSS JOIN kept LEFT JOIN queue q USING (seq) LEFT JOIN same USING (seq)"""


_PENDING = "toxicity_label <> 1 AND coalesce(gemini_skipped, 0) = 0 AND NOT EXISTS (SELECT 1 FROM llm_segments l WHERE l.id = t.id)"
_SENTENCES = rf"list_filter(list_transform(string_split(regexp_replace(text, '([.!?…])[{T.WHITE}]+', '\1' || chr(1), 'g'), chr(1)), lambda x: {_strip_sql('x')}), lambda x: x <> '')"
def _pack_sql(source: str) -> str:
    """CTEs up to ``packed`` (seq, parts): the segments of the texts (seq, text) of a query."""
    return rf"""texts AS MATERIALIZED (SELECT seq, text, len({_LOWER_WORDS}) <= 50 AND length(text) <= 500 AS fits, {_SENTENCES} AS s FROM ({source}) WHERE text IS NOT NULL),
    sentences AS MATERIALIZED (SELECT seq, k, text, len({_LOWER_WORDS}) AS n, {_LOWER_WORDS} AS tokens FROM (
        SELECT seq, unnest(s) AS text, generate_subscripts(s, 1) AS k FROM texts WHERE NOT fits)),
    big AS MATERIALIZED (SELECT seq, k, tokens FROM sentences WHERE n > 50 OR length(text) > 500),
    runs AS (SELECT seq, k, CAST(0 AS BIGINT) AS i, '' AS run, 0 AS n, CAST([] AS VARCHAR[]) AS out FROM big UNION ALL
        SELECT seq, k, i, CASE WHEN ends THEN '' ELSE longer END, CASE WHEN ends THEN 0 ELSE n END, CASE WHEN ends THEN list_append(out, longer) ELSE out END FROM (
            SELECT seq, k, i, n, out, longer, n >= 50 OR length(longer) >= 500 AS ends FROM (
                SELECT r.seq, r.k, r.i + 1 AS i, r.n + 1 AS n, r.out, CASE WHEN r.n = 0 THEN b.tokens[r.i + 1] ELSE r.run || ' ' || b.tokens[r.i + 1] END AS longer
                FROM runs r JOIN big b USING (seq, k) WHERE r.i < len(b.tokens)))),
    chunks AS MATERIALIZED (SELECT r.seq, r.k, CASE WHEN r.n > 0 THEN list_append(r.out, r.run) ELSE r.out END AS parts FROM runs r JOIN big b USING (seq, k) WHERE r.i = len(b.tokens)),
    fold AS (SELECT seq, CAST(0 AS BIGINT) AS k, '' AS held, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS out FROM texts WHERE NOT fits UNION ALL
        SELECT f.seq, s.k,
            CASE WHEN f.n + s.n <= 50 AND length(f.held) + (f.held <> '')::INT + length(s.text) <= 500 THEN CASE WHEN f.held = '' THEN s.text ELSE f.held || ' ' || s.text END
                WHEN c.parts IS NULL THEN s.text ELSE '' END,
            CASE WHEN f.n + s.n <= 50 AND length(f.held) + (f.held <> '')::INT + length(s.text) <= 500 THEN f.n + s.n WHEN c.parts IS NULL THEN s.n ELSE 0 END,
            CASE WHEN f.n + s.n <= 50 AND length(f.held) + (f.held <> '')::INT + length(s.text) <= 500 THEN f.out
                ELSE list_concat(CASE WHEN f.held = '' THEN f.out ELSE list_append(f.out, {_strip_sql('f.held')}) END, coalesce(c.parts, [])) END
        FROM fold f JOIN sentences s ON s.seq = f.seq AND s.k = f.k + 1 LEFT JOIN chunks c ON c.seq = s.seq AND c.k = s.k),
    packed AS (SELECT f.seq, list_filter(CASE WHEN f.held = '' THEN f.out ELSE list_append(f.out, {_strip_sql('f.held')}) END, lambda x: x <> '') AS parts FROM fold f JOIN texts t USING (seq) WHERE f.k = len(t.s)
        UNION ALL SELECT seq, list_filter([{_strip_sql('text')}], lambda x: x <> '') FROM texts WHERE fits)"""


_PACK = f"""WITH RECURSIVE {_pack_sql('SELECT seq, text FROM clean_segments')}
    SELECT seq, CAST(segment_no - 1 AS INTEGER) AS segment_no, segment FROM (SELECT seq, unnest(parts) AS segment, generate_subscripts(parts, 1) AS segment_no FROM packed)"""


def _xxh32_sql(name: str, source: str) -> str:
    """CTEs up to ``name`` (m, h): the XXH32 hash, with seed 0, of the texts (m) of a query. The primes are those of the algorithm."""
    one, two, three, four, five, m = 2654435761, 2246822519, 3266489917, 668265263, 374761393, 1 << 32

    def turn(x: str, by: int) -> str:
        return f"((({x}) << {by}) | (({x}) >> {32 - by})) % {m}"

    def lane(v: str, k: int) -> str:
        return f"list_reduce(list_prepend({v}::UBIGINT, list_transform(range(0, n // 16), lambda j: lanes[4 * j + {k}])), lambda v, x: {turn(f'(v + x * {two}) % {m}', 13)} * {one} % {m})"

    hexed = " || ".join(f"substr(hx, 8 * j + {k}, 2)" for k in (7, 5, 3, 1))
    return f"""{name}0 AS MATERIALIZED (SELECT m, hex(encode(m)) AS hx, octet_length(encode(m)) AS n FROM ({source})),
    {name}1 AS MATERIALIZED (SELECT *, list_transform(range(0, n // 4), lambda j: ('0x' || {hexed})::UBIGINT) AS lanes FROM {name}0),
    {name}2 AS MATERIALIZED (SELECT *, {lane(str((one + two) % m), 1)} AS a, {lane(str(two), 2)} AS b, {lane('0', 3)} AS c, {lane(str(m - one), 4)} AS d FROM {name}1),
    {name}3 AS (SELECT *, ((CASE WHEN n >= 16 THEN {turn('a', 1)} + {turn('b', 7)} + {turn('c', 12)} + {turn('d', 18)} ELSE {five} END + n) % {m})::UBIGINT AS h3 FROM {name}2),
    {name}4 AS MATERIALIZED (SELECT *, list_reduce(list_prepend(h3, lanes[4 * (n // 16) + 1:]), lambda v, x: {turn(f'(v + x * {three}) % {m}', 17)} * {four} % {m}) AS h4 FROM {name}3),
    {name}5 AS MATERIALIZED (SELECT *, list_reduce(list_prepend(h4, list_transform(range(n // 4 * 4, n), lambda j: ('0x' || substr(hx, 2 * j + 1, 2))::UBIGINT)), lambda v, x: {turn(f'(v + x * {five}) % {m}', 11)} * {one} % {m}) AS h5 FROM {name}4),
    {name}6 AS (SELECT m, (xor(h5, h5 >> 15) * {two} % {m})::UBIGINT AS h6 FROM {name}5),
    {name}7 AS (SELECT m, (xor(h6, h6 >> 13) * {three} % {m})::UBIGINT AS h7 FROM {name}6),
    {name} AS MATERIALIZED (SELECT m, xor(h7, h7 >> 16) AS h FROM {name}7)"""


def _hidden_sql(source: str, names: tuple[str, ...]) -> str:
    """CTEs up to ``hidden`` (seq, text): the texts of a query with names filled in and contacts hidden, stage by stage."""
    listed = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    inner = _strip_sql("substr(m, 3, length(m) - 4)")
    stages = [
        ("named", T.NAME_PLACEHOLDER, inner, f"{listed}[CAST(h % {len(names)} + 1 AS BIGINT)]" if names else "''"),
        ("mailed", f"(?i){T.EMAIL}", "m", "printf('mail%05d@example.com', h % 100000)"),
        ("phoned", T.PHONE, "m", "printf('+7 %03d %03d-%02d-%02d', 900 + h % 90, h // 100 % 1000, h % 10000 // 100, h % 100)"),
        ("hidden", rf"(?i)\b{T.URL}", "m", "printf('https://%06d.com', h % 1000000)"),
    ]
    out, before = [], f"({source})"
    for name, pattern, seed, made in stages:
        out.append(
            f"""{name}_p AS MATERIALIZED (SELECT seq, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM (SELECT seq, string_split_regex(text, '{pattern}') AS p FROM {before})),
    {name}_m AS MATERIALIZED (SELECT seq, k, {seed} AS m FROM (SELECT seq, unnest(x) AS m, generate_subscripts(x, 1) AS k FROM (SELECT seq, regexp_extract_all(text, '{pattern}') AS x FROM {before}))),
    {_xxh32_sql(name + '_h', f'SELECT DISTINCT m FROM {name}_m')},
    {name} AS MATERIALIZED (SELECT seq, string_agg(piece || coalesce({made}, ''), '' ORDER BY k) AS text FROM {name}_p LEFT JOIN {name}_m USING (seq, k) LEFT JOIN {name}_h USING (m) GROUP BY seq)"""
        )
        before = name
    return ",\n    ".join(out)


_NAMES = ("Айгөл", "Булат", "Ләйсән", "Тимур")
_SYSTEM = ", ".join(f"'{m}'" for m in DEFAULT.system_messages)
_PROCESSED = f"""raw AS MATERIALIZED (SELECT seq, {_RAW} AS raw, {_strip_sql(_RAW)} AS text, {_SOURCE} AS source FROM raw_messages),
    early AS MATERIALIZED (SELECT seq, text, source, CASE WHEN raw = '' THEN 'reject_empty' WHEN text = '' OR text IN ({_SYSTEM}) THEN 'reject_system_message'
        WHEN {_contact_only_sql('text')} THEN 'reject_contact_only_raw' END AS early FROM raw),
    {_hidden_sql(f"SELECT seq, {_regular_sql('text')} AS text FROM early WHERE early IS NULL", ())},
    clean AS MATERIALIZED (SELECT seq, text, {_contact_only_sql('text')} AS gone FROM hidden),
    {_pack_sql('SELECT seq, text FROM clean WHERE NOT gone')},
    parts AS MATERIALIZED (SELECT seq, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS segment_no FROM packed),
    judged AS MATERIALIZED (SELECT seq, segment_no, text, {_REASON} AS reason FROM parts),
    processed AS (SELECT e.seq, sha1(e.source) AS parent_digest, sha1(e.source) || '#' || j.segment_no AS id, j.text, coalesce(e.early, CASE WHEN c.gone THEN 'reject_contact_only_clean' END, j.reason, 'no_segments') AS reason
        FROM early e LEFT JOIN clean c USING (seq) LEFT JOIN judged j USING (seq))"""


def _last_sql(table: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS place FROM {table} WHERE id IS NOT NULL) WHERE place = 1)"


def _known(table: str) -> str:
    return f"CASE WHEN NOT isnan({table}.toxicity_score) THEN {table}.toxicity_score END"


_LATEST = f"latest AS {_last_sql('toxicity_segments')}"

# ---- sources and cleaning ----------------------------------------------------------


@query(f"SELECT seq, {_SOURCE} AS source_id, {_RAW} AS raw_text, sha1({_SOURCE}) AS parent_digest, sha1({_SOURCE} || chr(10) || {_RAW}) AS row_hash FROM raw_messages")
def scan_resolve_source(spark: SparkSession, folder: str) -> DataFrame:
    """Source id, raw text, digest and hash of every raw message."""
    return resolved(_texts(spark, folder, "raw_messages"), "seq").select("seq", "source_id", "raw_text", "parent_digest", "row_hash")


@query(f"SELECT seq, {_NORMAL} AS text FROM raw_messages")
def norm_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    raw = T.first_filled("text", "message")
    return _texts(spark, folder, "raw_messages").select("seq", T.normalise_whitespace(raw).alias("text"))


@query(rf"SELECT seq, regexp_replace(lower({_strip_sql('text')}), '[{T.WHITE}]+', ' ', 'g') AS form FROM clean_segments")
def dedup_normal_form(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "clean_segments").select("seq", T.normal_form("text").alias("form"))


@query(f"SELECT seq, len({_LOWER_WORDS}) AS n_tokens, length(text) AS n_chars FROM clean_segments")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "clean_segments").select("seq", T.count_tokens("text").cast("bigint").alias("n_tokens"), F.length("text").cast("bigint").alias("n_chars"))


@query(f"SELECT seq, len(regexp_extract_all(text, '[{DEFAULT.marker_letters}]')) AS n_markers, {_SCRIPT} AS n_script FROM clean_segments")
def marker_letter_count(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "clean_segments").select(
        "seq", T.count_letters("text", DEFAULT.marker_letters).cast("bigint").alias("n_markers"), T.count_class("text", DEFAULT.script).cast("bigint").alias("n_script")
    )


@query(
    f"SELECT seq, len(regexp_extract_all({_RAW}, '(?i){T.WORD_START}{T.URL}')) AS n_links, len(regexp_extract_all({_RAW}, '(?i){T.EMAIL}')) AS n_emails, "
    f"len(regexp_extract_all({_RAW}, '{T.PHONE}')) AS n_phones FROM raw_messages"
)
def contact_counts(spark: SparkSession, folder: str) -> DataFrame:
    raw = T.first_filled("text", "message")
    return _texts(spark, folder, "raw_messages").select(
        "seq", T.count_links(raw).cast("bigint").alias("n_links"), T.count_emails(raw).cast("bigint").alias("n_emails"), T.count_phones(raw).cast("bigint").alias("n_phones")
    )


@query(f"SELECT seq, {_contact_only_sql(_RAW)} AS contact_only FROM raw_messages")
def contact_only_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "raw_messages").select("seq", T.is_contact_only(T.first_filled("text", "message")).alias("contact_only"))


@query(f"SELECT seq, regexp_matches({_RAW}, '{T.SINGLE_BRACKET}') AS bracketed FROM raw_messages")
def single_bracket_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "raw_messages").select("seq", T.first_filled("text", "message").rlike(T.SINGLE_BRACKET).alias("bracketed"))


@query(f"SELECT seq, {_REASON} AS reason FROM clean_segments")
def filter_reason(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "clean_segments").select("seq", T.reject_reason("text").alias("reason"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM clean_segments) GROUP BY reason")
def filter_reason_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return segment.reason_counts(filter_reason(spark, folder))


@query(
    rf"""SELECT seq, sentence_no - 1 AS sentence_no, sentence FROM (SELECT seq, unnest(s) AS sentence, generate_subscripts(s, 1) AS sentence_no FROM (
    SELECT seq, list_filter(list_transform(string_split(regexp_replace(text, '([.!?…])[{T.WHITE}]+', '\1' || chr(1), 'g'), chr(1)), lambda x: {_strip_sql('x')}), lambda x: x <> '') AS s FROM clean_segments))"""
)
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = _texts(spark, folder, "clean_segments").select("seq", F.posexplode(T.sentences("text")).alias("sentence_no", "sentence"))
    return parts.withColumn("sentence_no", F.col("sentence_no").cast("bigint"))


@query(_PACK)
def segment_pack(spark: SparkSession, folder: str) -> DataFrame:
    """The segments that packing makes of every clean text: whole sentences up to the limits, oversized ones in word runs."""
    rows = _texts(spark, folder, "clean_segments").select("seq", F.posexplode(segment.segments_of("text")).alias("segment_no", "segment"))
    return rows.select("seq", "segment_no", "segment")


@query(f"WITH {_hidden_sql(f'SELECT seq, {_NORMAL} AS text FROM raw_messages', _NAMES)} SELECT seq, text FROM hidden")
def anonymised_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw message with contacts hidden and name placeholders filled."""
    raw = T.normalise_whitespace(T.first_filled("text", "message"))
    return _texts(spark, folder, "raw_messages").select("seq", anonymise(raw, _NAMES).alias("text"))


def _processed(spark: SparkSession, folder: str) -> DataFrame:
    return segment.process_messages(resolved(_texts(spark, folder, "raw_messages"), "seq"), "source_id", "raw_text", keep=("seq",))


@query(f"WITH RECURSIVE {_PROCESSED} SELECT seq, id, parent_digest, text FROM processed WHERE reason = 'pass'")
def message_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments that raw messages give and that pass every rule."""
    return _processed(spark, folder).where("reason = 'pass'").select("seq", "id", "parent_digest", "text")


@query(f"WITH RECURSIVE {_PROCESSED} SELECT reason, count(*) AS n FROM processed GROUP BY reason")
def message_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """How many messages and segments were rejected for which reason."""
    return segment.reason_counts(_processed(spark, folder))


# ---- duplicates ------------------------------------------------------------------------


@query("SELECT seq, id FROM (SELECT *, row_number() OVER (PARTITION BY norm_hash ORDER BY seq) AS n FROM clean_segments) WHERE n = 1 OR norm_hash IS NULL")
def exact_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return firstwins.keep_first(_texts(spark, folder, "clean_segments").select("seq", "id", "norm_hash"), "norm_hash", "seq").select("seq", "id")


@query(
    """WITH RECURSIVE marked AS MATERIALIZED (SELECT seq, id, norm_hash, (id IS NOT NULL AND count(*) OVER (PARTITION BY id) > 1) OR (norm_hash IS NOT NULL AND count(*) OVER (PARTITION BY norm_hash) > 1) AS contested
        FROM toxicity_segments WHERE seq IS NOT NULL),
    queue AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY seq) AS k FROM marked WHERE contested),
    walk AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS ids, CAST([] AS VARCHAR[]) AS hashes, CAST(NULL AS BIGINT) AS kept UNION ALL
        SELECT k, CASE WHEN free THEN list_append(ids, id) ELSE ids END, CASE WHEN free THEN list_append(hashes, norm_hash) ELSE hashes END, CASE WHEN free THEN seq END FROM (
            SELECT q.*, w.ids, w.hashes, NOT coalesce(list_contains(w.ids, q.id), false) AND NOT coalesce(list_contains(w.hashes, q.norm_hash), false) AS free FROM walk w JOIN queue q ON q.k = w.k + 1))
    SELECT seq, id, norm_hash FROM marked WHERE NOT contested OR seq IN (SELECT kept FROM walk WHERE kept IS NOT NULL)"""
)
def two_key_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Of the scored segments those an insert-or-ignore on id and on norm_hash would accept."""
    return firstwins.two_key_first(read_table(spark, folder, "toxicity_segments").select("seq", "id", "norm_hash"), "seq", "id", "norm_hash", materialise)


@query("SELECT seq, id, toxicity_label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS n FROM toxicity_segments) WHERE n = 1 OR id IS NULL")
def insert_or_replace_latest(spark: SparkSession, folder: str) -> DataFrame:
    return firstwins.keep_last(read_table(spark, folder, "toxicity_segments").select("seq", "id", "toxicity_label"), "id", "seq")


@query(
    "SELECT seq, id, norm_hash FROM toxicity_segments t WHERE seq IS NOT NULL AND NOT EXISTS (SELECT 1 FROM toxicity_segments u WHERE u.seq > t.seq AND u.id = t.id) "
    "AND NOT EXISTS (SELECT 1 FROM toxicity_segments u WHERE u.seq > t.seq AND u.norm_hash = t.norm_hash)"
)
def insert_or_replace_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Of the scored segments those that inserting in order leaves, where a row replaces all that share its id or norm_hash."""
    return firstwins.replace_last(read_table(spark, folder, "toxicity_segments").select("seq", "id", "norm_hash"), "seq", "id", "norm_hash")


@query(f"WITH {_simhash_sql('clean_segments')} SELECT * FROM simhashes")
def simhash_halves(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedup.with_simhash(_texts(spark, folder, "clean_segments").select("seq", "text").where("text IS NOT NULL"), "text")
    return rows.select("seq", F.shiftrightunsigned("simhash", 32).alias("simhash_hi"), F.col("simhash").bitwiseAND(F.lit(0xFFFFFFFF)).alias("simhash_lo"))


@query(
    f"""WITH {_simhash_sql('dedup_segments')}, firsts AS (SELECT simhash_hi AS hi, simhash_lo AS lo, min(seq) AS seq FROM simhashes GROUP BY 1, 2)
    SELECT a.seq AS seq_a, b.seq AS seq_b, CAST(bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) AS INTEGER) AS distance
    FROM firsts a JOIN firsts b ON a.seq < b.seq AND bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 2"""
)
def near_dup_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of different SimHash values within two bits, each named by its first segment; near_dup_members has the segments of each value."""
    rows = dedup.with_simhash(_texts(spark, folder, "dedup_segments").select("seq", "text"), "text")
    firsts = materialise(rows.where("simhash IS NOT NULL").groupBy("simhash").agg(F.min("seq").alias("seq")), "firsts")
    pairs = dedup.near_pairs(firsts, 2)
    a, b = firsts.select(F.col("simhash").alias("a"), F.col("seq").alias("x")), firsts.select(F.col("simhash").alias("b"), F.col("seq").alias("y"))
    return pairs.join(a, "a").join(b, "b").select(F.least("x", "y").alias("seq_a"), F.greatest("x", "y").alias("seq_b"), hamming("a", "b").alias("distance"))


@query(
    f"""WITH {_simhash_sql('dedup_segments')}, firsts AS (SELECT simhash_hi AS hi, simhash_lo AS lo, min(seq) AS seq, count(*) AS n FROM simhashes GROUP BY 1, 2),
    near AS (SELECT a.seq, sum(b.n) AS n FROM firsts a JOIN firsts b ON a.seq <> b.seq AND bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 2 GROUP BY a.seq)
    SELECT s.seq, f.seq AS first_seq, CAST(f.n - 1 + coalesce(near.n, 0) AS BIGINT) AS n_links
    FROM simhashes s JOIN firsts f ON s.simhash_hi = f.hi AND s.simhash_lo = f.lo LEFT JOIN near ON near.seq = f.seq"""
)
def near_dup_members(spark: SparkSession, folder: str) -> DataFrame:
    """The first segment of the SimHash value of every segment, and how many other segments are within two bits, those of its own value included.

    With near_dup_pairs it gives every pair of segments: those of one value, and of two values all with all.
    """
    made = dedup.with_simhash(_texts(spark, folder, "dedup_segments").select("seq", "text"), "text")
    rows = materialise(made.where("simhash IS NOT NULL").select("seq", "simhash"), "simhash")
    values = materialise(rows.groupBy("simhash").agg(F.min("seq").alias("first_seq"), F.count("*").alias("n")), "values")
    pairs = materialise(dedup.near_pairs(values, 2).select("a", "b"), "near")
    near = pairs.union(pairs.select("b", "a")).join(values.select(F.col("simhash").alias("b"), "n"), "b").groupBy(F.col("a").alias("simhash")).agg(F.sum("n").alias("near"))
    linked = values.join(near, "simhash", "left").select("simhash", "first_seq", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return rows.join(linked, "simhash").select("seq", "first_seq", "n_links")


@query(_greedy_sql("clean_segments", "CASE WHEN b.n_tokens <= 8 THEN 1 ELSE 2 END", True))
def near_dup_greedy(spark: SparkSession, folder: str) -> DataFrame:
    """What first-come-first-kept deduplication makes of every clean segment."""
    return dedup.deduplicate(_texts(spark, folder, "clean_segments"), "seq", "text", "norm_hash", materialise)


@query(_greedy_sql("dedup_segments", "3", False))
def near_dup_constant(spark: SparkSession, folder: str) -> DataFrame:
    """First-come-first-kept by nearness alone, three bits for texts of any length."""
    return dedup.greedy_constant(_texts(spark, folder, "dedup_segments"), "seq", "text", 3, materialise)


@query(f"SELECT status, count(*) AS n FROM ({_greedy_sql('clean_segments', 'CASE WHEN b.n_tokens <= 8 THEN 1 ELSE 2 END', True)}) GROUP BY status")
def dedup_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup_greedy(spark, folder).groupBy("status").agg(F.count("*").alias("n"))


# ---- scores, joins, logs ---------------------------------------------------------------


@query("SELECT seq FROM toxicity_segments WHERE NOT coalesce(toxicity_score >= 0.9 AND NOT isnan(toxicity_score), false)")
def toxic_filter(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.drop_toxic(read_table(spark, folder, "toxicity_segments").select("seq", "toxicity_label", "toxicity_score"), 0.9).select("seq")


@query("SELECT seq FROM toxicity_segments WHERE NOT coalesce(toxicity_score >= 0.9 AND NOT isnan(toxicity_score) AND toxicity_label = 1, false)")
def toxic_filter_by_label(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.drop_toxic(read_table(spark, folder, "toxicity_segments").select("seq", "toxicity_label", "toxicity_score"), 0.9, "toxic_score").select("seq")


@query(
    f"WITH {_LATEST} SELECT l.seq, l.id, coalesce(t.toxicity_label, l.toxicity_label) AS toxicity_label, coalesce({_known('t')}, {_known('l')}) AS toxicity_score "
    "FROM llm_segments l JOIN latest t USING (id)"
)
def toxicity_join_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    scored = read_table(spark, folder, "llm_segments").select("seq", "id", "toxicity_label", "toxicity_score")
    return membership.scored_join(scored, read_table(spark, folder, "toxicity_segments"), "id", ("toxicity_label", "toxicity_score"), "seq")


@query(f"SELECT seq, id FROM toxicity_segments t WHERE {_PENDING}")
def pending_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "toxicity_segments").select("seq", "id", "toxicity_label", "gemini_skipped")
    return membership.pending(rows, read_table(spark, folder, "llm_segments"), "id", "toxicity_label", "gemini_skipped").select("seq", "id")


@query(f"SELECT count(*) AS n_total, count(*) FILTER ({_PENDING}) AS n_pending FROM toxicity_segments t")
def pending_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "toxicity_segments")
    return membership.pending_counts(rows, read_table(spark, folder, "llm_segments"), "id", "toxicity_label", "gemini_skipped")


@query(
    f"""SELECT min(seq) AS seq, h AS row_hash FROM (SELECT seq, sha1({_SOURCE} || chr(10) || {_RAW}) AS h FROM raw_messages)
    WHERE h NOT IN (SELECT row_hash FROM ingest_log WHERE dataset = 'wall_messages:clean_trial' AND row_hash IS NOT NULL) GROUP BY h"""
)
def incremental_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Messages not yet logged for one output table, each hash once."""
    rows = resolved(_texts(spark, folder, "raw_messages"), "seq").select("seq", "row_hash")
    return membership.unseen(rows, read_table(spark, folder, "ingest_log"), "row_hash", "seq", {"dataset": "wall_messages:clean_trial"})


@query("SELECT t.seq, t.id, CASE WHEN coalesce(gemini_skipped, 0) > 0 OR t.id IN (SELECT id FROM llm_segments WHERE gemini_json IS NULL AND id IS NOT NULL) THEN 1 ELSE coalesce(gemini_skipped, 0) END AS gemini_skipped FROM toxicity_segments t")
def skip_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Skip marks joined from a log: here, of segments whose labelling gave nothing."""
    skips = read_table(spark, folder, "llm_segments").where("gemini_json IS NULL")
    return membership.with_skip_flag(read_table(spark, folder, "toxicity_segments").select("seq", "id", "gemini_skipped"), skips, "id", "gemini_skipped")


@query("SELECT DISTINCT id, 'review' AS target FROM llm_segments WHERE id NOT IN (SELECT id FROM toxicity_reviews WHERE id IS NOT NULL)")
def export_log_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    log = read_table(spark, folder, "toxicity_reviews").select("id", F.lit("review").alias("target"))
    return membership.new_log_rows(read_table(spark, folder, "llm_segments").select("id", F.lit("review").alias("target")), log, ["id", "target"])


# ---- labels and selection ----------------------------------------------------------------


@query(f"WITH {_labels_sql('any')}, f AS (SELECT seq, l IS NOT NULL AS any_valid FROM labelled), g AS ({'WITH ' + _labels_sql('flat')} SELECT seq, l IS NOT NULL AS flat_valid FROM labelled) SELECT seq, flat_valid, any_valid FROM f JOIN g USING (seq)")
def label_parse_valid(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "llm_segments").select("seq", flat_labels("gemini_json").isNotNull().alias("flat_valid"), any_labels("gemini_json").isNotNull().alias("any_valid"))


@query(f"WITH {_labels_sql('any')} SELECT seq, {', '.join(f'l.{f} AS {f}' for f in FIELDS)} FROM labelled WHERE l IS NOT NULL")
def label_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "llm_segments").select("seq", any_labels("gemini_json").alias("l")).where("l IS NOT NULL").select("seq", "l.*")


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = selection.source_rows(_texts(spark, folder, "llm_segments"), "gemini_json", "toxicity_label", "gemini_skipped")
    return selection.candidates(rows, "id", "text", "gemini_json")


@query(f"WITH {_CANDIDATES} SELECT id, density, round(score, 6) AS score FROM candidates")
def candidate_filter_score(spark: SparkSession, folder: str) -> DataFrame:
    return _candidates(spark, folder).select("id", "density", F.round("score", 6).alias("score"))


@query(f"WITH {_CANDIDATES} SELECT id, density, bucket_rank FROM ranked WHERE bucket_rank <= 50")
def bucket_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The best 50 candidates of each bucket."""
    found = _candidates(spark, folder)
    ranked = found.withColumn("bucket_rank", F.row_number().over(Window.partitionBy("density").orderBy(F.col("score").desc(), "id", "text")))
    return ranked.where("bucket_rank <= 50").select("id", "density", F.col("bucket_rank").cast("bigint").alias("bucket_rank"))


@query(_selection_sql(100, 0.15, True))
def selection_keep_proportions(spark: SparkSession, folder: str) -> DataFrame:
    return selection.select(_candidates(spark, folder), materialise, 100, 0.15, True).select("id", "density", F.col("bucket_rank").cast("bigint").alias("bucket_rank"))


@query(f"WITH {_CANDIDATES} SELECT id, density, bucket_rank FROM ranked")
def selection_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate with its rank: a selection without a limit."""
    return selection.select(_candidates(spark, folder), materialise, None, 0.15, False).select("id", "density", F.col("bucket_rank").cast("bigint").alias("bucket_rank"))


@query(_selection_sql(400, 0.1, False))
def selection_free_fill(spark: SparkSession, folder: str) -> DataFrame:
    return selection.select(_candidates(spark, folder), materialise, 400, 0.1, False).select("id", "density", F.col("bucket_rank").cast("bigint").alias("bucket_rank"))


# ---- exports -------------------------------------------------------------------------------


@query("SELECT id, text FROM toxicity_segments WHERE toxicity_label <> 1")
def export_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """id and text of what isn't labelled 1; without a label nothing is known, so such rows are left out."""
    return read_table(spark, folder, "toxicity_segments").where("toxicity_label <> 1").select("id", "text")


_EXPORT = f"""{_labels_sql('any')}, {_LATEST},
exported AS (SELECT p.seq, p.id, p.text, coalesce(t.toxicity_label, p.toxicity_label)::BIGINT AS toxicity_label, coalesce({_known('t')}, {_known('p')}) AS toxicity_score, {', '.join(f'l.{f} AS {f}' for f in FIELDS)}
    FROM {_last_sql('labelled')} p JOIN latest t USING (id)
    WHERE gemini_json IS NOT NULL AND gemini_json <> '' AND coalesce(t.toxicity_label, p.toxicity_label, 0) <> 1 AND coalesce(t.gemini_skipped, 0) = 0 AND l IS NOT NULL)"""


def _exported(spark: SparkSession, folder: str) -> DataFrame:
    return export.flattened(export.exportable(_texts(spark, folder, "llm_segments"), read_table(spark, folder, "toxicity_segments"), "gemini_json", "gemini_skipped"))


@query(f"WITH {_EXPORT} SELECT * FROM exported")
def labelled_export_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _exported(spark, folder)


def _bytes_sql() -> str:
    strings = ("id", "text", *WORDS)
    return " + ".join([f"coalesce(octet_length(encode({c})), 0) + 4" for c in strings] + [str(8 * (len(export.COLUMNS) - len(strings)))])


@query(
    f"""WITH {_EXPORT},
    numbered AS (SELECT seq, {_bytes_sql()} AS bytes, (row_number() OVER (ORDER BY seq) - 1) // 100 AS batch FROM exported),
    batches AS (SELECT batch, sum(bytes) AS bytes FROM numbered GROUP BY batch),
    sums AS (SELECT batch, coalesce(sum(bytes) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 100000 AS crossed FROM batches),
    parts AS (SELECT batch, CAST(dense_rank() OVER (ORDER BY crossed) - 1 AS INTEGER) AS part FROM sums)
    SELECT seq, part FROM numbered JOIN parts USING (batch)"""
)
def part_assignment(spark: SparkSession, folder: str) -> DataFrame:
    """The file that each exported row goes to, for files of 100 kB and batches of 100 rows."""
    return export.part_numbers(materialise(_exported(spark, folder), "exported"), "seq", 100, 100_000, materialise)


@query(
    f"""WITH waiting AS (SELECT seq, id, text, (row_number() OVER (ORDER BY seq) - 1) // 64 AS batch_no FROM toxicity_segments t WHERE {_PENDING})
    SELECT batch_no, CAST(count(*) AS INTEGER) AS n_items, 'Rate each text.' || chr(10) || to_json(struct_pack(task := 'scoring', items := list(struct_pack(id := coalesce(id, ''), text := coalesce(text, '')) ORDER BY seq)))::VARCHAR AS prompt
    FROM waiting GROUP BY batch_no"""
)
def batch_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The prompts for all pending segments, 64 rows each in order of seq."""
    rows = read_table(spark, folder, "toxicity_segments").select("seq", "id", "text", "toxicity_label", "gemini_skipped")
    waiting = membership.pending(rows, read_table(spark, folder, "llm_segments"), "id", "toxicity_label", "gemini_skipped").select("seq", "id", "text", F.lit(1).cast("bigint").alias("one"))
    placed = export.running_total(waiting, "seq", "one", materialise).select("seq", F.floor(F.col("before") / 64).alias("batch_no"))
    items = waiting.join(placed, "seq").groupBy("batch_no").agg(F.array_sort(F.collect_list(F.struct("seq", "id", "text"))).alias("items"))
    plain = F.transform("items", lambda i: F.struct(F.coalesce(i["id"], F.lit("")).alias("id"), F.coalesce(i["text"], F.lit("")).alias("text")))
    return items.select("batch_no", F.size("items").alias("n_items"), F.concat(F.lit("Rate each text.\n"), F.to_json(F.struct(F.lit("scoring").alias("task"), plain.alias("items")))).alias("prompt"))


def _offline_service():
    """A service without a network: labels from counts of the text, and nothing for every 29th text length."""

    def call(key: str, rows: list[dict]) -> dict:
        return {r["id"]: {"length": len(r["text"]), "words": len(r["text"].split())} for r in rows if len(r["text"]) % 29}

    return call


@query(
    rf"""WITH waiting AS (SELECT id, min(coalesce(text, '')) AS text FROM toxicity_segments t WHERE {_PENDING} GROUP BY id)
    SELECT id, CASE WHEN length(text) % 29 = 0 THEN 'skipped' ELSE 'ok' END AS status,
        CASE WHEN length(text) % 29 <> 0 THEN '{{"length": ' || length(text) || ', "words": ' || len(regexp_extract_all(text, '[^{T.SPACE}]+')) || '}}' END AS labels_json,
        CASE WHEN length(text) % 29 = 0 THEN 'missing' END AS reason FROM waiting"""
)
def scorer_offline(spark: SparkSession, folder: str) -> DataFrame:
    """All pending segments through the request scheduler, with a service that answers at once."""
    rows = read_table(spark, folder, "toxicity_segments").select("seq", "id", "text", "toxicity_label", "gemini_skipped")
    waiting = membership.pending(rows, read_table(spark, folder, "llm_segments"), "id", "toxicity_label", "gemini_skipped")
    accounts = {f"account_{i}": [f"key_{i}"] for i in range(1, 5)}
    asked = waiting.groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    scored = scoring.score_with_service(asked, accounts, _offline_service, materialise, pause=False)
    return scored.where("status <> 'account'").select("id", "status", "labels_json", "reason")
