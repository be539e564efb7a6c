"""Scalar text functions, with the odd cases that a plain rewrite gets wrong."""

import re

import pytest
import regex
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import privacy
from textloom.functions import text as T
from textloom.operators.segment import pack, process_messages, reason_counts, segments_of, split_by_marks, word_runs
from textloom.profile import Profile


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.select(make(F.col("t")), "i").orderBy("i").collect()]


SPACES = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", " "]


def plain_whitespace(t):
    t = re.sub("[\u200b\ufeff\u2060]", "", t.replace("\r", ""))
    return "\n".join(re.sub("[ \t\f\v\u00a0]+", " ", line).strip() for line in t.splitlines())


def test_whitespace_cases(spark):
    cases = {"a\t b \r\n c": "a b\nc", "а\u200bб": "аб", "a\n\n": "a\n", "": "", "a\u2028b\x85c": "a\nb\nc", " \u3000x\u2003 ": "x", "a\x0bb": "a\nb"}
    assert column(spark, [*cases, None], T.normalise_whitespace) == [*cases.values(), None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from([*SPACES, "a", "Б", ".", "\u200b", "\ufeff"]), max_size=14), min_size=30, max_size=120))
def test_whitespace_is_that_of_a_plain_version(spark, texts):
    assert column(spark, texts, T.normalise_whitespace) == [plain_whitespace(t) for t in texts]
    assert column(spark, texts, T.normal_form) == [regex.sub(r"\s+", " ", t.strip().lower()) for t in texts]


def test_contact_only(spark):
    texts = ["https://a.b  mail@x.org", "\U0001f642\U0001f642!!!", "", "ok https://a.b", "8 917 123 45 67", None]
    assert column(spark, texts, T.is_contact_only) == [True, True, True, False, True, None]


def test_tokens(spark):
    texts = ["Don't O'Neill's ١٢ x_y", "", None, "и\u0306"]
    assert column(spark, texts, T.tokens) == [["don't", "o'neill", "s", "١٢", "x", "y"], [], None, ["и"]]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("aБ1'_ .\u0301٢Я"), max_size=20), min_size=30, max_size=120))
def test_tokens_are_those_of_a_plain_version(spark, texts):
    assert column(spark, texts, T.tokens) == [regex.findall(r"[\p{L}\d]+(?:'[\p{L}\d]+)?", t.lower()) for t in texts]


def test_digests(spark):
    import hashlib

    got = spark.createDataFrame([("u", "t"), (None, "t")], "u string, t string").select(T.row_hash("u", "t")).collect()
    assert [r[0] for r in got] == [hashlib.sha1(b"u\nt").hexdigest(), None]
    assert column(spark, ["wall/1:x", None], T.safe_token) == ["wall_1_x", None]


def test_sentences(spark):
    assert column(spark, ["A. B! C", "x…\u00a0y", "", None, " . "], T.sentences) == [["A.", "B!", "C"], ["x…", "y"], [], None, ["."]]


def test_reject_reasons(spark):
    good = "Әни бүген өйдә тәмле икмәк пешерде, җиңел булды"
    texts = [good, "abc", "Просто обычный русский текст без особых букв вообще", "Әни әти үги", good + " [id1|X] а", None, (good + " ") * 9]
    assert column(spark, texts, T.reject_reason) == ["pass", "min_letters", "min_tatar_letters", "min_letters", "single_bracket_placeholder", None, "max_words"]
    strict = Profile(one_script_only=True)
    assert column(spark, [good + " x", good + " α", good], lambda c: T.reject_reason(c, strict)) == ["latin_present", "non_cyrillic_letters", "pass"]
    with pytest.raises(ValueError):
        Profile(min_words=9, max_words=3)


def one(text):
    return privacy.hide_contacts([text])[0]


def phone(seed):
    h = xxhash.xxh32(seed).intdigest()
    return f"+7 {900 + h % 90} {h // 100 % 1000:03d}-{h % 10000 // 100:02d}-{h % 100:02d}"


def test_stand_ins():
    h = xxhash.xxh32("mail@x.org").intdigest()
    assert one("a mail@x.org b") == f"a mail{h % 100000:05d}@example.com b"
    # The blank before a number belongs to its match.
    assert one("тел 9171234567") == "тел" + phone(" 9171234567")
    assert one("тел 89171234567") == "тел" + phone(" 8917123456") + "7"
    # A number inside a link is replaced first, and the link ends at its blank.
    inside = phone("9171234567")
    link = xxhash.xxh32("https://x.y/" + inside.split(" ")[0]).intdigest()
    assert one("https://x.y/9171234567/z") == f"https://{link % 1000000:06d}.com" + inside[2:] + "/z"
    # Texts of one batch don't mix.
    assert privacy.hide_contacts(["a", "mail@x.org", "", "тел 9171234567"]) == ["a", f"mail{h % 100000:05d}@example.com", "", "тел" + phone(" 9171234567")]
    assert privacy.fill_names(["[[ John ]] x", "y"], ["А", "Б", "В"]) == [["А", "Б", "В"][xxhash.xxh32("John").intdigest() % 3] + " x", "y"]
    assert privacy.fill_names(["[[John]] x"], []) == [" x"]


def test_anonymise_leaves_plain_texts(spark):
    texts = ["plain", "[[Ann]] hi", "a@b.org", None, ""]
    assert column(spark, texts, lambda c: privacy.anonymise(c, ["N"])) == ["plain", "N hi", one("a@b.org"), None, ""]


def test_both_engines_agree(spark):
    """What the JVM and the Arrow step make of white space and contacts is the same."""
    from textloom.operators.segment import contact_only, regular_space

    texts = ["", " ", "a  b", "a\r\n b\n\n c \u200b\x0b d\x85e\u2028 f\n", "\ta\u00a0\u00a0b\f", "89171234567", "x@y.org!", "тел: +7 (917) 123-45-67", "WWW.a.b 😀", "\u200b", "https://x y", "a@b", "12 34"]
    assert column(spark, texts, T.normalise_whitespace) == [regular_space(t) for t in texts]
    assert column(spark, texts, T.is_contact_only) == [contact_only(t) for t in texts]


def test_packing():
    words = " ".join(f"сүз{i}" for i in range(60))
    assert [len(s.split()) for s in pack(words)] == [50, 10]
    two = " ".join(["а"] * 30) + ". " + " ".join(["б"] * 21) + "."
    assert pack(two) == [" ".join(["а"] * 30) + ".", " ".join(["б"] * 21) + "."]
    assert pack("  ") == [] and pack(" x ") == ["x"]
    assert word_runs("Aa, Bb! Cc", Profile(max_words=2, min_words=1)) == ["aa bb", "cc"]
    assert split_by_marks("A. \n B") == ["A.", "B"]


def slow_runs(s, p):
    out, run = [], []
    for w in regex.findall(r"[\p{L}\d]+(?:'[\p{L}\d]+)?", s.lower()):
        run.append(w)
        if len(run) >= p.max_words or len(" ".join(run)) >= p.max_chars:
            out.append(" ".join(run))
            run = []
    return [*out, " ".join(run)] if run else out


def slow_pack(text, p):
    """The same rule, measured anew on joined texts at every step."""

    def fits(s):
        return len(regex.findall(r"[\p{L}\d]+(?:'[\p{L}\d]+)?", s.lower())) <= p.max_words and len(s) <= p.max_chars

    if fits(text):
        return [text.strip()] if text.strip() else []
    out, held = [], ""
    for s in split_by_marks(text):
        joined = f"{held} {s}" if held else s
        if fits(joined):
            held = joined
            continue
        if held:
            out.append(held.strip())
        held = ""
        if fits(s):
            held = s
        else:
            out += slow_runs(s, p)
    return [s for s in [*out, held.strip()] if s]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab. !…\n'"), max_size=80))
def test_packing_is_that_of_a_plain_version(text):
    p = Profile(min_words=1, max_words=4, min_chars=1, max_chars=15)
    assert pack(text, p) == slow_pack(text, p)


def test_segments_in_spark(spark):
    texts = ["short one.", None, "", " ".join(["сүз"] * 60)]
    assert [None if s is None else len(s) for s in column(spark, texts, segments_of)] == [1, None, 0, 2]


def test_messages(spark):
    good = "Әни бүген өйдә тәмле икмәк пешерде, җиңел булды"
    rows = [(1, "u", ""), (2, "u", "   "), (3, "u", "Post is not in text format."), (4, "u", "https://a.b  mail@x.org"), (5, "u", good), (6, None, good), (7, "u", None), (8, "u", "[[x]] !!"), (9, "u", (good + ". ") * 12)]
    df = spark.createDataFrame(rows, "seq long, url string, raw string").withColumn("text", F.lit("a clashing column"))
    done = process_messages(df, "url", "raw", keep=("seq",))
    got = {}
    for r in done.collect():
        got.setdefault(r.seq, []).append((r.reason, r.id, r.text))
    assert [got[i][0][0] for i in (1, 2, 3, 4, 7, 8)] == ["reject_empty", "reject_system_message", "reject_system_message", "reject_contact_only_raw", "reject_empty", "reject_contact_only_clean"]
    assert got[5] == [("pass", "51e69892ab49df85c6230ccc57f8e1d1606caccc#0", good)]
    assert got[6] == [("pass", None, good)]
    assert {i for _, i, _ in got[9]} == {f"51e69892ab49df85c6230ccc57f8e1d1606caccc#{k}" for k in range(len(got[9]))} and len(got[9]) > 1
    assert sum(r.n for r in reason_counts(done).collect()) == done.count()
    assert process_messages(df.limit(0), "url", "raw").count() == 0
